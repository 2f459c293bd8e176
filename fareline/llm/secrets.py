"""Secret scanning through nested encodings."""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import partial
from itertools import chain

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from fareline.llm.common import map_texts, place_of

# --- fixed values: the kinds in their order, their patterns and least lengths ---
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
# ---------------------------------------------------------------------------------
# Compressed bytes are read so many decompressed bytes at a time, so that a bomb cannot take the worker's memory, and
# each part of a text is searched with so many bytes of the one before it.
PART_BYTES = 1 << 20
OVERLAP_BYTES = 1 << 16
# A guard against bombs that never end: decompressed bytes that one layer may have.
LARGEST_LAYER = 1 << 34
# Largest window of zstandard data: what its decompressor holds.
WINDOW_BYTES = 1 << 27
MASK = "[SECRET]"

_KEYWORD = re.compile(r"(?i)passw|secret|token|api_?key", re.ASCII)
_LONG_HEX = re.compile(r"[0-9a-f]{24,}")
_ESCAPED_BYTES = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
# Raw ASCII with byte escapes in it, as URL quoting and the repr of bytes write them.
_ASCII = re.compile(r"[ -~]+")
_PERCENT_BYTE = re.compile(r"%([0-9A-Fa-f]{2})")
_SLASH_BYTE = re.compile(r"""\\x([0-9A-Fa-f]{2})|\\u00([0-9A-Fa-f]{2})|\\([abfnrtv0\\'"])""")
_SLASH_VALUES = dict(zip("abfnrtv0\\'\"", b"\a\b\f\n\r\t\v\0\\'\"", strict=True))
_ESCAPED_CHARS = re.compile(
    r"\\u\{([0-9A-Fa-f]{1,6})\}|((?:\\u[0-9A-Fa-f]{4})+)|\\U([0-9A-Fa-f]{8})|((?:\\x[0-9A-Fa-f]{2})+)"
    r"|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:\r?\n[A-Za-z0-9+/_-]{16,})*(?:\r?\n[A-Za-z0-9+/_-]{1,15}(?=[=\s]|$))?={0,2}")
# How compressed bytes begin, and stretches of UTF-8 without control characters that can hold a secret (12 bytes).
_MAGIC = re.compile(rb"\x1f\x8b|\x78[\x01\x5e\x9c\xda]|\x28\xb5\x2f\xfd|BZh|\xfd7zXZ\x00")
_CLEAN = re.compile(
    rb"(?:[\x09-\x0d\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}"
    rb"|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}){12,}")
_WIDE_LOW = re.compile(rb"(?:[\x09-\x0d\x20-\x7e\xa0-\xff]\x00){12,}")
_WIDE_HIGH = re.compile(rb"(?:\x00[\x09-\x0d\x20-\x7e\xa0-\xff]){12,}")
_BREAK = re.compile(rb"[\x09-\x0d\x20]")
_LINE, _PART = re.compile(r"[^\r\n]{16,}"), re.compile(r"[A-Za-z0-9+]{16,}")
_FROM_URL_SAFE = str.maketrans("-_", "+/")

Span = tuple[int, int, int]  # start, kind, end


def base_spans(text: str) -> list[Span]:
    """Spans of the plain text, leftmost and disjoint within a kind, those too short left out."""
    found = []
    if _KEYWORD.search(text):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    # A run of hex digits has the least length exactly if that many stand together.
    found += [(m.start(), 2, m.end()) for m in _LONG_HEX.finditer(text)]
    return sorted(found)


@dataclass(frozen=True)
class Layer:
    """A decoded text with the range of the document each character comes from.

    That is the character's own place, or the same ``whole`` for all, or one range for each in ``starts`` and ``ends``.
    """

    text: str
    starts: np.ndarray | None = None
    ends: np.ndarray | None = None
    whole: tuple[int, int] | None = None

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if self.whole is not None:
            return self.whole
        if self.starts is None:
            return start, end
        return int(self.starts[start:end].min()), int(self.ends[start:end].max())


_BROKEN = (zlib.error, zstandard.ZstdError, OSError, lzma.LZMAError, EOFError, ValueError)


class _Source:
    """Bytes that come in parts, read as a file; what was read too much can be put back."""

    def __init__(self, parts: Iterable[bytes | memoryview]):
        self.parts, self.held, self.taken = iter(parts), b"", 0

    def read(self, size: int = -1) -> bytes:
        while not len(self.held):
            part = next(self.parts, None)
            if part is None:
                return b""
            self.held = bytes(part[:PART_BYTES]) if len(part) <= PART_BYTES else self._cut(part)
        got, self.held = (self.held, b"") if size < 0 else (self.held[:size], self.held[size:])
        self.taken += len(got)
        return got

    def _cut(self, part: bytes | memoryview) -> bytes:
        view = memoryview(part)
        self.parts = chain((view[at:at + PART_BYTES] for at in range(PART_BYTES, len(view), PART_BYTES)), self.parts)
        return bytes(view[:PART_BYTES])

    def back(self, data: bytes) -> None:
        self.held = data + self.held
        self.taken -= len(data)

    def head(self) -> bytes:
        """The next eight bytes, which stay."""
        got = self.read(8)
        while len(got) < 8 and (more := self.read(8 - len(got))):
            got += more
        self.back(got)
        return got


def _unpacker(head: bytes):
    """What opens compressed bytes that begin like these; None for others."""
    if head[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if head[:1] == b"\x78" and len(head) > 2 and int.from_bytes(head[:2], "big") % 31 == 0:
        return zlib.decompressobj()
    if head[:4] == b"\x28\xb5\x2f\xfd":
        return zstandard.ZstdDecompressor(max_window_size=WINDOW_BYTES)
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    return None


def _parts_of(source: _Source) -> Iterator[bytes]:
    """The content of compressed bytes in parts of at most ``PART_BYTES``, through all members or frames that follow each other.

    Of broken bytes what is readable is given. ``source.taken`` is how many bytes it took.
    """
    total = 0
    while (unpack := _unpacker(source.head())) is not None and total < LARGEST_LAYER:
        before = source.taken
        try:
            for part in _zstandard(unpack, source) if isinstance(unpack, zstandard.ZstdDecompressor) else _stream(unpack, source):
                total += len(part)
                yield part
                if total >= LARGEST_LAYER:
                    break
        except _BROKEN:
            return
        if source.taken == before:
            return


def _stream(unpack, source: _Source) -> Iterator[bytes]:
    """Of zlib's, bzip2's and xz's decompressors, which tell differently what they still have to read."""
    rest = b""
    while not unpack.eof:
        if not rest and getattr(unpack, "needs_input", True):
            rest = source.read()
            if not rest:
                return
        part = unpack.decompress(rest, PART_BYTES)
        rest = getattr(unpack, "unconsumed_tail", b"")
        if part:
            yield part
    source.back(unpack.unused_data)


def _zstandard(unpack, source: _Source) -> Iterator[bytes]:
    """One byte is read at a time, so that no byte behind the frame is taken."""
    with unpack.stream_reader(source, read_size=1, closefd=False) as reader:
        while (part := reader.read(PART_BYTES)):
            yield part
            if len(part) < PART_BYTES:  # the frame's last; asking once more would take a byte behind it
                return


def _clean_texts(data: bytes) -> Iterator[tuple[int, int, str]]:
    """Stretches of text in bytes: of UTF-8 (in which ASCII is) without control characters, and of UTF-16 in Latin letters
    of either byte order. Other bytes, such as Latin-1 letters or a mark at the start, end a stretch."""
    for m in _CLEAN.finditer(data):
        yield *m.span(), m[0].decode("utf-8")
    if b"\x00" in data:
        for pattern, order in ((_WIDE_LOW, "utf-16-le"), (_WIDE_HIGH, "utf-16-be")):
            for m in pattern.finditer(data):
                yield *m.span(), m[0].decode(order)


def _held_in(parts: Callable[[], Iterable[bytes | memoryview]], whole: tuple[int, int]) -> Iterator[Layer]:
    """Texts in what compressed bytes hold, and in compressed bytes therein; all come from the range ``whole``.

    ``parts`` gives the compressed bytes, anew at each call. Decompressed bytes are searched a part at a time, together with the end
    of the part before; compressed ones among them are followed as far as they go, by reading up to their start once more where
    they reach beyond the part.
    """
    def rest(skip: int) -> Iterator[bytes]:
        for part in _parts_of(_Source(parts())):
            if skip < len(part):
                yield part[skip:]
            skip = max(0, skip - len(part))

    held, before = b"", 0
    for part in _parts_of(_Source(parts())):
        data = held + part
        start = before - len(held)
        for _, _, text in _clean_texts(data):
            yield Layer(text, whole=whole)
        for m in _MAGIC.finditer(data):
            if m.end() > len(held):  # else it was found in the part before
                inner = data[m.start():]
                yield from _held_in(partial(_followed, inner, partial(rest, start + len(data))), whole)
        before += len(part)
        held = data[-OVERLAP_BYTES:]
        if len(data) > OVERLAP_BYTES and (space := _BREAK.search(held)):  # begin with a word
            held = held[space.end():]


def _followed(first: bytes, rest: Callable[[], Iterator[bytes]]) -> Iterator[bytes]:
    """The second is made only if the first is used up."""
    yield first
    yield from rest()


def _compressed_in(data: bytes, starts: np.ndarray, ends: np.ndarray) -> Iterator[Layer]:
    """What compressed bytes hold that begin anywhere in ``data``."""
    for m in _MAGIC.finditer(data):
        at = m.start()
        source = _Source([memoryview(data)[at:]])
        if not any(map(len, _parts_of(source))):
            continue
        for _ in _parts_of(measure := _Source([memoryview(data)[at:]])):
            pass
        stop = at + max(1, measure.taken)
        whole = int(starts[at:stop].min()), int(ends[at:stop].max())
        yield from _held_in(partial(iter, (memoryview(data)[at:stop],)), whole)


def _ranges(layer: Layer, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    if layer.whole is not None:
        return np.full(end - start, layer.whole[0]), np.full(end - start, layer.whole[1])
    if layer.starts is None:
        at = np.arange(start, end)
        return at, at + 1
    return layer.starts[start:end], layer.ends[start:end]


def _rewritten(layer: Layer, found: list[tuple[int, int, str, np.ndarray, np.ndarray]]) -> Layer:
    """The layer with regions replaced by decoded text."""
    texts, starts, ends, at = [], [], [], 0
    for begin, end, text, s, e in found:
        for part, (a, b) in ((layer.text[at:begin], _ranges(layer, at, begin)), (text, (s, e))):
            texts.append(part)
            starts.append(a)
            ends.append(b)
        at = end
    texts.append(layer.text[at:])
    s, e = _ranges(layer, at, len(layer.text))
    return Layer("".join(texts), np.concatenate([*starts, s]), np.concatenate([*ends, e]))


def _whole(layer: Layer, begin: int, end: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    s, e = layer.origin(begin, end)
    return np.full(n, s), np.full(n, e)


def _bytes_layer(data: bytes, starts: np.ndarray, ends: np.ndarray) -> Iterator[Layer]:
    """Texts in bytes that come each from a range."""
    for begin, end, text in _clean_texts(data):
        s, e = starts[begin:end], ends[begin:end]
        if len(text) == end - begin:
            yield Layer(text, s, e)
            continue
        if data[begin:end].count(0) * 2 >= end - begin:  # two bytes a character
            lead = np.arange(0, end - begin, 2)
        else:
            lead = np.flatnonzero((np.frombuffer(data[begin:end], np.uint8) & 0xC0) != 0x80)
        yield Layer(text, s[lead], e[np.r_[lead[1:], end - begin] - 1])


def _as_text(data: bytes) -> str | None:
    """Bytes as text if they are UTF-8 without control characters other than white space."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return None if re.search(r"[\x00-\x08\x0e-\x1f\x7f]", text) else text


def _quoted_layers(layer: Layer, escape: re.Pattern) -> Iterator[Layer]:
    """What compressed bytes hold of which some are escaped and others stand as they are."""
    for m in _ASCII.finditer(layer.text):
        escapes = list(escape.finditer(m[0]))
        if not escapes:
            continue
        data = np.frombuffer(m[0].encode("ascii"), np.uint8).copy()
        kept = np.ones(len(data), bool)
        last = np.arange(len(data))
        for x in escapes:
            digits = next(filter(None, x.groups()))
            data[x.start()] = int(digits, 16) if len(digits) == 2 else _SLASH_VALUES[digits]
            kept[x.start() + 1:x.end()] = False
            last[x.start()] = x.end() - 1
        plain = data[kept].tobytes()
        forms = [plain]
        if escape is _PERCENT_BYTE and "+" in m[0]:  # in forms, a plus sign that is not escaped is a space
            data[np.frombuffer(m[0].encode("ascii"), np.uint8) == ord("+")] = ord(" ")
            forms.append(data[kept].tobytes())
        for held in forms:
            if not _MAGIC.search(held):
                continue
            s, e = _ranges(layer, m.start(), m.end())
            yield from _compressed_in(held, s[kept], e[last[kept]])


def _url_layers(layer: Layer) -> Iterator[Layer]:
    """The text with its percent escapes decoded, and what compressed escapes hold."""
    if "%" not in layer.text:
        return
    yield from _quoted_layers(layer, _PERCENT_BYTE)
    found = []
    for m in _ESCAPED_BYTES.finditer(layer.text):
        data = binascii.unhexlify(m[0].replace("%", ""))
        s, e = _ranges(layer, m.start(), m.end())
        starts, ends = np.minimum.reduceat(s, np.arange(0, len(s), 3)), np.maximum.reduceat(e, np.arange(0, len(e), 3))
        if (text := _as_text(data)) is not None:
            if len(text) < len(data):
                lead = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
                starts, ends = starts[lead], ends[np.r_[lead[1:], len(data)] - 1]
            found.append((m.start(), m.end(), text, starts, ends))
        else:
            yield from _bytes_layer(data, starts, ends)
    if found:
        yield _rewritten(layer, found)


def _unicode_layers(layer: Layer) -> Iterator[Layer]:
    """The text with ``\\u``, ``\\x`` and numeric character references decoded, and what compressed escapes hold."""
    if "\\" not in layer.text and "&#" not in layer.text:
        return
    yield from _quoted_layers(layer, _SLASH_BYTE)
    found = []
    for m in _ESCAPED_CHARS.finditer(layer.text):
        if m[2]:
            units = binascii.unhexlify(m[2].replace("\\u", ""))
            text = units.decode("utf-16-be", "replace")
            # One or two escapes of six characters make a character.
            size = np.array([12 if ord(c) > 0xFFFF else 6 for c in text])
        elif m[4]:
            data = binascii.unhexlify(m[4].replace("\\x", ""))
            text = data.decode("utf-8", "replace") if _as_text(data) else data.decode("latin-1")
            size = np.array([4 * (len(c.encode("utf-8")) if len(text) < len(data) else 1) for c in text])
        else:
            code = int(m[1] or m[3] or m[5] or m[6], 10 if m[6] else 16)
            if code > 0x10FFFF or 0xD800 <= code < 0xE000:
                continue
            text, size = chr(code), np.array([m.end() - m.start()])
        cut = np.cumsum(size)
        s, e = _ranges(layer, m.start(), m.end())
        if len(s) != cut[-1]:  # broken surrogates: each character comes from the whole run
            starts, ends = _whole(layer, m.start(), m.end(), len(text))
        else:
            first = cut - size
            starts, ends = np.minimum.reduceat(s, first), np.maximum.reduceat(e, first)
        found.append((m.start(), m.end(), text, starts, ends))
    if found:
        yield _rewritten(layer, found)


def _base64_layers(layer: Layer) -> Iterator[Layer]:
    """What each run of base64 holds, compressed or not.

    A run may begin and end with neighbours that are no part of a payload: path names, other lines, words. Whatever
    part of it is base64 of its own stands whole in the bytes of one of the four alignments, so each is decoded and
    searched for text and compressed bytes. Lines and parts between ``/``, ``-`` and ``_`` are also taken by themselves,
    which ends them where they end.
    """
    for m in _BASE64.finditer(layer.text):
        begin, run = m.start(), m[0].rstrip("=")
        for skip in range(4):
            yield from _decoded(layer, begin, run, skip)
        for pattern in (_LINE, _PART):
            for part in pattern.finditer(run):
                if len(part[0]) < len(run):
                    yield from _decoded(layer, begin + part.start(), part[0], 0)


def _decoded(layer: Layer, begin: int, run: str, skip: int) -> Iterator[Layer]:
    """Texts and contents of compressed bytes in the base64 run at ``begin`` without its first ``skip`` digits."""
    at = [i for i, c in enumerate(run) if c not in "\r\n"][skip:] if "\n" in run else None
    digits = (re.sub(r"[\r\n]", "", run) if at else run).translate(_FROM_URL_SAFE)[skip:]
    usable = len(digits) - (len(digits) % 4 == 1)
    try:
        data = binascii.a2b_base64(digits[:usable] + "=" * (-usable % 4))
    except binascii.Error:
        return
    magic = _MAGIC.search(data)
    if not magic and _CLEAN.search(data) is None and (b"\x00" not in data or not (_WIDE_LOW.search(data) or _WIDE_HIGH.search(data))):
        return
    s, e = _ranges(layer, begin, begin + len(run))
    s, e = (s[at], e[at]) if at else (s[skip:], e[skip:])
    k = np.arange(len(data))
    first, last = k * 4 // 3, np.minimum(((k + 1) * 4 + 2) // 3, len(digits)) - 1
    starts, ends = np.minimum(s[first], s[last]), np.maximum(e[first], e[last])
    yield from _bytes_layer(data, starts, ends)
    if magic:
        yield from _compressed_in(data, starts, ends)


def all_spans(text: str, base: list[Span] | None = None) -> list[Span]:
    """Base spans and those of every layer below, as ranges of the document.

    A worklist unwraps percent escapes, character escapes, base64 and compressed bytes of each layer until none
    gives a new one, the last layer found first, so that only one layer of each depth is held. A layer is known by its content and
    range, so a text that decodes to itself, or a loop of them, ends.
    """
    found = set(base_spans(text) if base is None else base)
    seen = {(hashlib.sha256(text.encode("utf-8", "replace")).digest(), 0, len(text))}

    def below(layer: Layer) -> Iterator[Layer]:
        return chain.from_iterable(unwrap(layer) for unwrap in (_url_layers, _unicode_layers, _base64_layers))

    work = [below(Layer(text))]
    while work:
        inner = next(work[-1], None)
        if inner is None:
            work.pop()
            continue
        if not inner.text:
            continue
        key = (hashlib.sha256(inner.text.encode("utf-8", "replace")).digest(), *inner.origin(0, len(inner.text)))
        if key in seen:
            continue
        seen.add(key)
        for start, kind, end in base_spans(inner.text):
            begin, stop = inner.origin(start, end)
            found.add((begin, kind, stop))
        work.append(below(inner))
    return sorted(found)


def masked(text: str, spans: list[Span], mask: str = MASK) -> str:
    """The text with every span, overlapping ones as one, replaced."""
    out, at = [], 0
    for start, _, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


_SPANS = "array<struct<kind:string,start:long,end:long>>"


def _told(spans: list[Span]) -> list[dict]:
    return [{"kind": KINDS[kind], "start": start, "end": end} for start, kind, end in spans]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, base, spans``, arrays of ``kind, start, end`` in code points, end exclusive.

    ``base`` has what the plain text shows, ``spans`` in addition what its layers hold; both are in order of start,
    then kind. Whole texts are read; null counts as empty (no spans). Repeated rows and null doc_ids come out as they
    came in, an empty table as none. One pass, no shuffle.
    """

    def each(ids: list, texts: list) -> dict:
        base = [base_spans(t or "") for t in texts]
        return {"doc_id": ids, "base": [_told(b) for b in base],
                "spans": [_told(all_spans(t or "", b)) for t, b in zip(texts, base, strict=True)]}

    return map_texts(docs, each, f"doc_id long, base {_SPANS}, spans {_SPANS}", id_col, text_col)


def mask_secrets(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The documents with all spans masked, all columns kept; the length column, if there, follows the text.

    Texts without spans stay as they are, null stays null; repeated rows come out alike, an empty table gives an empty result. The
    text and length columns may differ in case.
    """
    @F.pandas_udf(StringType())
    def cleaned(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else masked(t, s) if (s := all_spans(t)) else t for t in texts],
                         dtype="object")

    columns = docs.columns
    at = place_of(columns, text_col)
    out = docs.toDF(*(f"c{i}" for i in range(len(columns)))).withColumn(f"c{at}", cleaned(F.col(f"c{at}").cast("string")))
    if length_col is not None and length_col.lower() in (c.lower() for c in columns):
        i = place_of(columns, length_col)
        kind = docs.schema.fields[i].dataType
        out = out.withColumn(f"c{i}", F.when(F.col(f"c{at}").contains(MASK), F.length(f"c{at}").cast(kind)).otherwise(
            F.col(f"c{i}")))
    return out.toDF(*columns)
