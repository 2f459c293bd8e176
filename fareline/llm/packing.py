"""Packing token ids into fixed windows by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from fareline.llm.common import slices, texts_of

WINDOW = 2048
# The rest of a document beyond its full windows is cut into pieces of at most this many ids.
PIECE = 512
# Windows that are balanced together; bounds what a task holds, and the last window of a group is the one left short.
GROUP_WINDOWS = 256
_CACHED_WORDS = 800_000
# Text whose words are told apart together.
_CHUNK_BYTES = 1 << 23
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
# Punctuation that, after a letter, is a token run of its own whatever comes before the letter.
_TRAILING = ".,;:!?%$&*#"
_TAIL = r"(?P<tail>[.,;:!?%$&*#]+)$"
# Below this come letters only that lower-casing and composition treat one by one.
_LATIN_END = "\u0250"


def _byte_letters() -> dict[int, str]:
    """The character a byte-level vocabulary has for each byte: itself if it can be seen, else one from 256 on."""
    seen = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in seen]
    return {**{b: chr(b) for b in seen}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


_LETTER_OF_BYTE = _byte_letters()

PACKED = "doc_id long, start long, length long, {ids}, doc_tokens long, sequence_id long, offset long"


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Indexes of ``sizes`` dealt to ``windows`` near-equal sums.

    A partial partition is a list of loads. The two with the largest spread are merged time and again,
    the heaviest window of one with the lightest of the other, until one partition is left.
    """
    merges: list[tuple[int, int]] = []
    n = len(sizes)
    heap = [(-size, i, np.array([size]), np.array([i])) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    serial = n
    while len(heap) > 1:
        _, _, a, a_nodes = heapq.heappop(heap)
        _, _, b, b_nodes = heap[0]
        both = max(0, len(a) + len(b) - windows)  # windows that hold something of either
        if both:
            lone = len(a) - both
            sums = a[lone:] + b[::-1][:both]
            made = np.arange(both) + n + len(merges)
            merges.extend(zip(a_nodes[lone:].tolist(), b_nodes[::-1][:both].tolist(), strict=True))
            loads = np.concatenate([a[:lone], sums, b[:len(b) - both]])
            nodes = np.concatenate([a_nodes[:lone], made, b_nodes[:len(b) - both]])
        else:
            loads, nodes = np.concatenate([a, b]), np.concatenate([a_nodes, b_nodes])
        order = np.argsort(-loads, kind="stable")
        loads, nodes = loads[order], nodes[order]
        least = int(loads[-1]) if len(loads) == windows else 0
        heapq.heapreplace(heap, (least - int(loads[0]), serial, loads, nodes))
        serial += 1
    dealt = []
    for root in (heap[0][3].tolist() if heap else []):
        leaves, stack = [], [root]
        while stack:
            node = stack.pop()
            if node < n:
                leaves.append(node)
            else:
                stack.extend(merges[node - n])
        dealt.append(leaves)
    return dealt


def balanced(sizes: list[int], capacity: int) -> list[list[int]]:
    """Near-equal windows within the capacity: as few as the total needs, more where one is exceeded."""
    if not sizes:
        return []
    if max(sizes) > capacity:
        raise ValueError("a piece exceeds the capacity")
    windows = -(-sum(sizes) // capacity)
    while True:
        dealt = differencing(sizes, windows)
        if all(sum(sizes[i] for i in window) <= capacity for window in dealt):
            return dealt
        windows += 1


class _Remembered:
    """Ids of word forms: forms as a column, their ids one after the other."""

    def __init__(self) -> None:
        self.forms = pa.array([], pa.large_string())
        self.first, self.size = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, "<u4")

    def places(self, forms: pa.Array) -> np.ndarray:
        """Where each form is, -1 for those that are not."""
        return pc.fill_null(pc.index_in(forms, value_set=self.forms), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def add(self, forms: pa.Array, ids: list[bytes]) -> int:
        """How many places the others moved up: the half that was added first is forgotten where there are too many."""
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        at = max(0, len(self.forms) - _CACHED_WORDS // 2) if len(self.forms) + len(forms) > _CACHED_WORDS else 0
        start = int(self.first[at]) if at < len(self.first) else len(self.ids)
        self.ids = np.concatenate([self.ids[start:], np.frombuffer(b"".join(ids), "<u4")])
        self.forms = pa.concat_arrays([self.forms.slice(at), forms])
        self.size = np.concatenate([self.size[at:], size])
        self.first = np.cumsum(self.size) - self.size
        return at


class WordTokens:
    """Token ids of texts by a lower-casing tokenizer that splits letters, punctuation and white space.

    No token reaches across ASCII white space, so words are encoded by themselves and remembered; the tokenizer sees
    each about once per task, and of those that differ in ASCII case or trailing punctuation only one.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known, self.tails = _Remembered(), _Remembered()

    def _tokenized(self, words: list[bytes]) -> list[bytes]:
        """A word of Latin letters is one run for the model; all others take the way through the whole tokenizer."""
        out: list[bytes] = []
        others = []
        tokenize, pack = self.model.tokenize, struct.pack
        for word in words:
            if word.isalpha() and word.islower():  # ASCII letters stand for themselves
                ids = [token.id for token in tokenize(word.decode("ascii"))]
            else:
                text = word.decode("utf-8")
                if not (text.isalpha() and max(text) < _LATIN_END and len(lower := text.lower()) == len(text)):
                    others.append((len(out), text))
                    out.append(b"")
                    continue
                letters = lower.encode("utf-8").decode("latin-1").translate(_LETTER_OF_BYTE)
                ids = [token.id for token in tokenize(letters)]
            out.append(pack(f"<{len(ids)}I", *ids))
        coded = self.tokenizer.encode_batch_fast([text for _, text in others], add_special_tokens=False)
        for (at, _), found in zip(others, coded, strict=True):
            out[at] = pack(f"<{len(found.ids)}I", *found.ids)
        return out

    @staticmethod
    def _parts(words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Forms of the words with the same ids, in two parts that are encoded apart.

        ASCII words are lower-cased and punctuation after a letter is cut off; the marks of special tokens are case-sensitive, so
        words with ``<`` stay as they are.
        """
        marked = pc.match_substring(words, "<")
        lowered = pc.if_else(pc.and_not(pc.string_is_ascii(words), marked), pc.ascii_lower(words), words)
        heads = pc.ascii_rtrim(lowered, characters=_TRAILING)
        whole = pc.or_(marked, pc.invert(pc.match_substring_regex(heads, "[A-Za-z]$")))
        tails = pc.fill_null(pc.struct_field(pc.extract_regex(lowered, _TAIL), "tail"), "")
        return pc.if_else(whole, lowered, heads), pc.if_else(whole, pa.scalar("", pa.large_string()), tails)

    def _ids_of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of distinct words, and where those of each word begin and how many there are."""
        parts = [part.dictionary_encode() for part in self._parts(words)]
        (ids1, first1, size1), (ids2, first2, size2) = (
            self._found(known, part.dictionary) for known, part in zip((self.known, self.tails), parts, strict=True))
        head, tail = (part.indices.to_numpy(zero_copy_only=False) for part in parts)
        first = np.stack([first1[head], first2[tail] + len(ids1)], 1).ravel()
        size = np.stack([size1[head], size2[tail]], 1).ravel()
        both = np.concatenate([ids1, ids2])
        long = size1[head] + size2[tail]
        return both[_runs(first, size)], np.cumsum(long) - long, long

    def _found(self, known: _Remembered, forms: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All remembered ids, and where those of each form begin and how many there are; new forms are tokenized."""
        at = known.places(forms)
        new = np.flatnonzero(at < 0)
        if len(new):
            end = len(known.forms)
            moved = known.add(forms.take(pa.array(new)), self._tokenized(forms.take(pa.array(new)).view(pa.large_binary()).to_pylist()))
            at[new] = end + np.arange(len(new))
            at -= moved
            if (at < 0).any():  # some that were known are forgotten by that
                own = self._tokenized(forms.view(pa.large_binary()).to_pylist())
                size = np.fromiter(map(len, own), np.int64, len(own)) // 4
                return np.frombuffer(b"".join(own), "<u4"), np.cumsum(size) - size, size
        return known.ids, known.first[at], known.size[at]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        out: list[bytes] = []
        held: list[bytes] = []
        size = 0
        for text in texts:
            data = (text or "").encode("utf-8", "replace")
            if len(data) > _CHUNK_BYTES:
                out += self._encoded(held)
                held, size = [], 0
                out.append(b"".join(ids for cut in _chunks(data) for ids in self._encoded([cut])))
                continue
            held.append(data)
            size += len(data)
            if size > _CHUNK_BYTES:
                out += self._encoded(held)
                held, size = [], 0
        return out + self._encoded(held)

    def _encoded(self, texts: list[bytes]) -> list[bytes]:
        """Words are told apart, made distinct and put back as columns; only distinct ones are Python objects."""
        if not texts:
            return []
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).view(pa.large_string()))
        words = split.flatten().dictionary_encode()
        ids, first, size = self._ids_of(words.dictionary)
        at = words.indices.to_numpy(zero_copy_only=False)
        picked = ids[_runs(first[at], size[at])].tobytes()
        ends = np.r_[0, np.cumsum(size[at])]
        bounds = ends[split.offsets.to_numpy() - split.offsets[0].as_py()] * 4
        return [picked[i:j] for i, j in pairwise(bounds.tolist())]


def _runs(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indexes of runs that begin at ``first`` and have ``size`` members, one run after the other."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(first - (ends - size), size)


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """Ids and texts of so many rows that their text is about what is told apart together."""
    doc_ids: list = []
    texts: list = []
    size = 0
    for batch in slices(batches):
        doc_ids += batch.column(0).to_pylist()
        texts += (found := batch.column(1).to_pylist())
        size += sum(len(t) for t in found if t)
        if size >= _CHUNK_BYTES:
            yield doc_ids, texts
            doc_ids, texts, size = [], [], 0
    if doc_ids:
        yield doc_ids, texts


def _chunks(data: bytes) -> Iterator[bytes]:
    """A long text in parts that end at white space, or where a word is longer than a part, after that word."""
    at = 0
    while at < len(data):
        end = min(len(data), at + _CHUNK_BYTES)
        if end < len(data):
            m = _SPACE.search(data, end)
            end = m.start() if m else len(data)
        yield data[at:end]
        at = end


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    return WordTokens(path)


class _Packer:
    """Pieces of one task, packed a group at a time."""

    def __init__(self, window: int, piece: int, group_windows: int, first_sequence: int, digest: bool = False):
        self.digest = digest
        self.window, self.piece, self.room = window, piece, window * group_windows
        self.sequence = first_sequence
        self.waiting: list[tuple] = []
        self.waiting_ids = 0
        self.ready: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total = len(ids) // 4
        full = total - total % self.window
        for start in range(0, full, self.window):
            self.ready.append((doc_id, start, self.window, ids[4 * start:4 * (start + self.window)], total,
                               self.sequence, 0))
            self.sequence += 1
        rest = total - full
        parts = -(-rest // self.piece)
        for i in range(parts):  # near-equal pieces
            start, end = full + rest * i // parts, full + rest * (i + 1) // parts
            self.waiting.append((doc_id, start, end - start, ids[4 * start:4 * end], total))
        self.waiting_ids += rest
        if self.waiting_ids >= self.room:
            self.close()

    def close(self) -> None:
        pieces, self.waiting, self.waiting_ids = self.waiting, [], 0
        for window in balanced([p[2] for p in pieces], self.window):
            offset = 0
            for i in sorted(window):
                self.ready.append((*pieces[i], self.sequence, offset))
                offset += pieces[i][2]
            self.sequence += 1

    def taken(self) -> pa.RecordBatch | None:
        rows, self.ready = self.ready, []
        if not rows:
            return None
        columns = list(zip(*rows, strict=True))
        kinds = [pa.int64()] * 3 + [pa.int64() if self.digest else pa.binary()] + [pa.int64()] * 3
        if self.digest:
            columns[3] = list(map(zlib.crc32, columns[3]))
        names = [part.split()[0] for part in packed(self.digest).split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)], names)


def packed(digest: bool = False) -> str:
    return PACKED.format(ids="ids_crc32 long" if digest else "ids binary")


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, window: int = WINDOW, piece: int = PIECE,
         group_windows: int = GROUP_WINDOWS, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """Pieces of all documents in sequences of at most ``window`` ids; ``ids`` are little-endian 32-bit numbers, of which with
    ``digest`` only the CRC-32 leaves the task (``ids_crc32``).

    A document is its ids followed by ``end_id``; null and empty texts are that id alone. Full windows of
    a document are sequences of their own. The rest is cut into near-equal pieces of at most ``piece`` ids,
    and each task balances the pieces of about ``group_windows`` windows at a time: differencing gives
    near-equal windows, one more being opened as long as any exceeds the capacity. Each id is in exactly
    one piece and pieces fill their sequence from offset 0 without gaps. Everything happens in the pass
    that reads the rows: no shuffle, and a task holds one group. Sequence ids are unique, not consecutive.
    Repeated rows are packed each; null doc_ids stay null; an empty table gives no piece.
    """
    from pyspark.sql.types import StructType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(tokenizer_path)
        end = np.array([end_id], "<u4").tobytes()
        packer = _Packer(window, piece, group_windows, TaskContext.get().partitionId() << 33, digest)
        for doc_ids, texts in _together(batches):
            for doc_id, ids in zip(doc_ids, tokens.encode(texts), strict=True):
                packer.add(doc_id, ids + end)
            if (out := packer.taken()):
                yield out
        packer.close()
        if (out := packer.taken()):
            yield out
        pa.default_memory_pool().release_unused()  # the worker goes on to other tasks

    return texts_of(docs, id_col, text_col).mapInArrow(run, StructType.fromDDL(packed(digest)))
