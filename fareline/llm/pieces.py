"""SentencePiece BPE encoding and decoding by vectorised merge rounds."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from fareline.llm.common import map_texts

SPACE = "▁"
_CODES = 0x110000
_NEVER = np.iinfo(np.int32).max
_CACHED_WORDS = 250_000
# Characters merged at once; bounds the arrays of a round.
_ROUND_CHARS = 1 << 20


class PieceModel:
    """A BPE model with byte fallback, a space put before the text and no other normalisation.

    Symbols are piece ids; a character that is no piece is the number of pieces plus its code point.
    """

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        spec, trained = proto.normalizer_spec, proto.trainer_spec
        if (trained.model_type != trained.BPE or not trained.byte_fallback or spec.precompiled_charsmap
                or spec.remove_extra_whitespaces or not spec.add_dummy_prefix or not spec.escape_whitespaces
                or trained.treat_whitespace_as_suffix):
            raise ValueError("only plain BPE models with byte fallback are supported")
        kinds = type(proto.pieces[0])
        self.size = len(proto.pieces)
        normal = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE}
        if len(normal) + len(self.bytes) + sum(
                p.type in (kinds.CONTROL, kinds.UNKNOWN) for p in proto.pieces) != self.size:
            raise ValueError("user-defined and unused pieces are not supported")
        self.symbol = np.arange(_CODES, dtype=np.int64) + self.size
        for piece, i in normal.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i
        scores = sorted({p.score for p in proto.pieces if p.type == kinds.NORMAL}, reverse=True)
        order = {score: rank for rank, score in enumerate(scores)}
        keys, merged, joined = [], [], set()
        for piece, i in normal.items():
            joined.update(zip(piece, piece[1:], strict=False))
            for cut in range(1, len(piece)):
                ends = [self.symbol[ord(x)] if len(x) == 1 else normal.get(x) for x in (piece[:cut], piece[cut:])]
                if None not in ends:
                    keys.append(int(ends[0]) * (self.size + _CODES) + int(ends[1]))
                    merged.append(i)
        sort = np.argsort(np.array(keys, np.int64))
        self.keys, self.merged = np.array(keys, np.int64)[sort], np.array(merged, np.int64)[sort]
        ranks = np.array([order.get(p.score, _NEVER) for p in proto.pieces], np.int32)
        self.ranks = ranks[self.merged]
        # Between two characters that are neighbours in no piece, no merge can ever take place.
        self.neighbours = np.array(sorted(ord(x) * _CODES + ord(y) for x, y in joined), np.int64)
        self.breaks_at_newline = not any("\n" in piece for piece in normal)
        surfaces = [p.piece.replace(SPACE, " ").encode() if p.type == kinds.NORMAL else
                    bytes([int(p.piece[3:5], 16)]) if p.type == kinds.BYTE else
                    trained.unk_surface.encode() if p.type == kinds.UNKNOWN else b"" for p in proto.pieces]
        self.surface = np.frombuffer(b"".join(surfaces), np.uint8)
        self.surface_size = np.array([len(s) for s in surfaces], np.int64)
        self.surface_at = np.cumsum(self.surface_size) - self.surface_size
        self.known: dict[str, bytes] = {}

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of neighbouring symbols; no rank where they do not merge."""
        wanted = left * (self.size + _CODES) + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        hit = self.keys[at] == wanted
        return np.where(hit, self.ranks[at], _NEVER), self.merged[at]

    def merge(self, words: list[str]) -> list[np.ndarray]:
        """Symbols of each word after all merges.

        A round finds, in every segment, the least pair rank and merges all its leftmost disjoint
        occurrences at once, up to the first whose merge makes a pair that would come before the next. Segments without
        a pair leave; the rest is compacted. That equals merging the best pair, the leftmost of equals, one at a time.
        """
        codes = np.frombuffer("".join(words).encode("utf-32-le", "replace"), "<u4").astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), sizes)
        if not len(codes):
            return [np.empty(0, np.int64) for _ in words]
        bound = np.ones(len(codes), bool)
        pair = codes[:-1] * _CODES + codes[1:]
        at = np.minimum(np.searchsorted(self.neighbours, pair), len(self.neighbours) - 1)
        bound[1:] = (word[1:] != word[:-1]) | (self.neighbours[at] != pair)
        segment = np.cumsum(bound) - 1
        segment_word = word[bound]
        done: list[tuple[np.ndarray, np.ndarray]] = []
        symbol = self.symbol[codes]
        while len(symbol):
            n = len(symbol)
            rank, made = np.full(n, _NEVER, np.int32), np.zeros(n, np.int64)
            rank[:-1], made[:-1] = self._pairs(symbol[:-1], symbol[1:])
            last = np.r_[segment[1:] != segment[:-1], True]
            rank[last] = _NEVER
            starts = np.flatnonzero(np.r_[True, last[:-1]])
            least = np.minimum.reduceat(rank, starts)
            best = np.repeat(least, np.diff(np.r_[starts, n]))
            going = best != _NEVER
            if not going.all():
                done.append((segment[~going], symbol[~going]))
                segment, symbol, rank, made, best = (x[going] for x in (segment, symbol, rank, made, best))
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == best)
            run = np.r_[True, at[1:] != at[:-1] + 1]
            first = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
            new = made[at]
            # Symbols left and right of each merge at its moment: those on the left have merged, those on the right not.
            after = symbol.copy()
            after[at] = new
            previous = at - 1
            follows = np.r_[False, at[1:] == at[:-1] + 2]
            previous = np.where(follows, at - 2, previous)
            has_left = (previous >= 0) & (segment[previous] == segment[at])
            next_ = np.minimum(at + 2, len(symbol) - 1)
            has_right = (at + 2 < len(symbol)) & (segment[next_] == segment[at])
            sooner = np.zeros(len(at), bool)
            sooner[has_left] = self._pairs(after[previous[has_left]], new[has_left])[0] <= best[at[has_left]]
            sooner[has_right] |= self._pairs(new[has_right], symbol[next_[has_right]])[0] <= best[at[has_right]]
            if sooner.any():
                owner = segment[at]
                stops, where = np.unique(owner[sooner], return_index=True)
                stop_at = at[sooner][where]
                k = np.minimum(np.searchsorted(stops, owner), len(stops) - 1)
                keep = (stops[k] != owner) | (at <= stop_at[k])
                at, new = at[keep], new[keep]
            symbol[at] = new
            stay = np.ones(len(symbol), bool)
            stay[at + 1] = False
            segment, symbol = segment[stay], symbol[stay]
        segments = np.concatenate([x for x, _ in done])
        symbols = np.concatenate([x for _, x in done])
        order = np.argsort(segments, kind="stable")
        owner = segment_word[segments[order]]
        return np.split(symbols[order], np.searchsorted(owner, np.arange(1, len(words))))

    def _ids(self, symbols: np.ndarray) -> np.ndarray:
        """Piece ids; a character that is no piece becomes its UTF-8 bytes."""
        if (symbols < self.size).all():
            return symbols
        out: list[int] = []
        for s in symbols.tolist():
            out += [s] if s < self.size else [self.bytes[b] for b in chr(s - self.size).encode("utf-8")]
        return np.array(out, np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, without begin and end ids."""
        split = [self._words(text) for text in texts]
        if len(self.known) > _CACHED_WORDS:
            self.known.clear()
        unknown = list(set().union(*split).difference(self.known))
        plain = [w if w[:1] in (SPACE, "\n") else SPACE + w for w in unknown]
        at = 0
        while at < len(plain):
            end, room = at, _ROUND_CHARS
            while end < len(plain) and (room > 0 or end == at):
                room -= len(plain[end])
                end += 1
            for w, symbols in zip(unknown[at:end], self.merge(plain[at:end]), strict=True):
                self.known[w] = self._ids(symbols).astype("<i4").tobytes()
            at = end
        ids = self.known.__getitem__
        return [np.frombuffer(b"".join(map(ids, words)), "<i4") for words in split]

    def _words(self, text: str) -> list[str]:
        """Parts of a text across which no piece reaches; a part without a mark of its own begins with a space."""
        if not text:
            return []
        if self.breaks_at_newline and not (text[0] == " " or "  " in text or " \n" in text or SPACE in text):
            return text.replace("\n", " \n").split(" ")
        return re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + text.replace(" ", SPACE))

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: surfaces joined, less one space before the first; broken bytes become U+FFFD."""
        ids = np.asarray(ids, np.int64)
        sizes = self.surface_size[ids]
        total = int(sizes.sum())
        if not total:
            return ""
        begin = np.cumsum(sizes) - sizes
        data = self.surface[np.repeat(self.surface_at[ids] - begin, sizes) + np.arange(total)].tobytes()
        return data.decode("utf-8", "replace").removeprefix(" ")


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def encode_and_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, ids, decoded``; null counts as empty (no ids, empty text).

    The model is read on the executors. A row is worked on by itself: no shuffle, any text length; repeated rows
    and null doc_ids come out as they came in, an empty table as none.
    """

    def each(ids: list, texts: list) -> dict:
        model = piece_model(model_path)
        encoded = model.encode([t or "" for t in texts])
        return {"doc_id": ids, "ids": encoded, "decoded": [model.decode(e) for e in encoded]}

    return map_texts(docs, each, "doc_id long, ids array<int>, decoded string", id_col, text_col)
