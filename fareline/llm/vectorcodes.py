"""Vector codes: parts of vectors as codebook entries, the nearest one found by LAESA pivots."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.llm.common import Saved, pick, slices

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
PIVOTS = 4
# Components beyond this, either way, count as it, so that squared distances fit into 64 bits.
LARGEST = 1 << 24
_ROWS = 2048
# Relative error of a distance kept in 32 bits, and of the roots, with room to spare.
_SLACK = np.float32(1e-6)


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, index]`` and, for each part position, the ``pivots`` that stay the same in all rounds."""

    entries: np.ndarray
    pivots: np.ndarray

    @property
    def sha256(self) -> str:
        """Of all components by part, entry and position, as decimal numbers joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def pivots_of(entries: np.ndarray, count: int) -> np.ndarray:
    """For each part position ``count`` entries far from each other: the first, then always the one farthest from those chosen."""
    chosen = []
    for book in entries:
        at = [0]
        far = _squares(book, book[0])
        while len(at) < min(count, len(book)):
            at.append(int(far.argmax()))
            far = np.minimum(far, _squares(book, book[at[-1]]))
        chosen.append(book[at])
    return np.stack(chosen)


def _squares(rows: np.ndarray, to: np.ndarray) -> np.ndarray:
    apart = rows - to
    return (apart * apart).sum(-1)


def pivot_distances(parts: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """``(rows, parts, pivots)`` Euclidean distances, in 32 bits."""
    out = np.empty((len(parts), *pivots.shape[:2]), np.float32)
    for p in range(pivots.shape[1]):
        out[:, :, p] = np.sqrt(_squares(parts, pivots[None, :, p]))
    return out


def nearest_entries(part: np.ndarray, near: np.ndarray, book: np.ndarray, pivots: np.ndarray,
                    count: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry and its squared distance for every row of one part position.

    ``near`` has the rows' distances to the pivots. How much they differ from an entry's is a lower bound of its
    distance: entries are measured in order of the bound, exactly and in integers, until the bound of the next is above the best
    distance found. Of equally near entries the first is taken. ``count`` gets the number of entries measured.
    """
    rows = np.arange(len(part))
    bound = np.zeros((len(part), len(book)), np.float32)
    for p in range(len(pivots)):
        own, theirs = near[:, p], np.sqrt(_squares(book, pivots[p])).astype(np.float32)
        low = np.abs(own[:, None] - theirs)
        low -= _SLACK * (own[:, None] + theirs)
        np.maximum(bound, low, out=bound)
    bound *= bound
    bound *= np.float32(1) - _SLACK
    index = bound.argmin(1)
    best = _squares(part, book[index])
    measured = len(part)
    bound[rows, index] = np.inf
    while len(rows):
        at = bound.argmin(1)
        go = bound[np.arange(len(rows)), at] <= best[rows]
        if not go.all():
            rows, bound, at = rows[go], bound[go], at[go]
        found = _squares(part[rows], book[at])
        measured += len(rows)
        closer = (found < best[rows]) | ((found == best[rows]) & (at < index[rows]))
        index[rows[closer]], best[rows[closer]] = at[closer], found[closer]
        bound[np.arange(len(rows)), at] = np.inf
    if count is not None:
        count.append(measured)
    return index, best


def whole_parts(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(vec_id, label, v)`` with each component as floor(256 x), for vectors without null or non-finite components."""
    rows = pick(vectors, (id_col, "long", "vec_id"), (label_col, "long", "label"), (vector_col, "array<double>", "v"))
    finite = rows.filter("v IS NOT NULL").filter(F.forall("v", lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))))
    edge = F.lit(LARGEST).cast("long")
    return finite.select("vec_id", "label", F.transform("v", lambda x: F.greatest(-edge, F.least(
        edge, F.floor(x * SCALE))).cast("int")).alias("v"))


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    """Rows padded with zeros to ``dims``."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), dims), np.int32)
    out[np.arange(dims) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _numbers(column: pa.BinaryArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _assigned(batch: pa.RecordBatch, books: Codebooks) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each part position its rows, their entry and squared distance."""
    count, _, width = books.entries.shape
    parts = _numbers(batch.column("parts"), np.int32).reshape(-1, count, width).astype(np.int64)
    near = _numbers(batch.column("near"), np.float32).reshape(len(parts), count, -1)
    for j in range(count):
        part = np.ascontiguousarray(parts[:, j])
        yield part, *nearest_entries(part, near[:, j], books.entries[j], books.pivots[j])


def _sums(books: Codebooks) -> Callable:
    """Arrow function: per task and used entry the number of its parts and their sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = np.zeros(books.entries.shape[:2], np.int64)
        sums = np.zeros(books.entries.shape, np.int64)
        for batch in slices(batches, _ROWS):
            for j, (part, index, _) in enumerate(_assigned(batch, books)):
                used[j] += np.bincount(index, minlength=used.shape[1])
                for d in range(part.shape[1]):  # whole numbers far below 2^53
                    sums[j, :, d] += np.bincount(index, weights=part[:, d], minlength=used.shape[1]).astype(np.int64)
        j, e = np.nonzero(used)
        yield pa.RecordBatch.from_arrays(
            [pa.array(j.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(used[j, e]),
             pa.array(sums[j, e].tolist(), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    return run


def _moved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after a round: each entry the floor of the mean of its parts; unused ones stay."""
    width = books.entries.shape[2]
    sums = rows.select("parts", "near").mapInArrow(_sums(books), "part int, entry int, n long, sums array<long>")
    totals = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(
        F.sum(F.col("sums")[d].cast("decimal(38,0)")).alias(f"s{d}") for d in range(width)))
    entries = books.entries.copy()
    for row in totals.collect():  # a row an entry at most
        entries[row.part, row.entry] = [int(row[f"s{d}"]) // row.n for d in range(width)]
    return Codebooks(entries, books.pivots)


@dataclass(frozen=True)
class Coded:
    """``rows`` has ``vec_id, label, code, error`` of every vector; ``books`` decode them."""

    rows: DataFrame
    books: Codebooks


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, pivots: int = PIVOTS,
             id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> Coded:
    """Codes of all vectors, of which each part is the index of an entry of its position's codebook.

    Components count as floor(256 x), at most 2^24 either way. Vectors that are null or hold null or non-finite
    components take no part. Vectors are cut into ``parts`` equal parts; shorter ones count as padded with zeros to the
    longest, and that to a multiple of ``parts``. A codebook starts as the parts of the ``entries`` rows with the smallest vec_ids (rows that
    repeat one by their vectors, null ids last); fewer rows give fewer entries. Each round assigns every part to its nearest entry, ties
    to the lower index, and moves entries to the floor of the mean of their parts. ``error`` is the final squared
    distance summed over the parts; ``code`` has two hex digits a part. Repeated rows are coded alike, null labels and ids stay
    null, an empty table gives an empty result and empty codebooks.

    Distances of all parts to a few fixed entries, the pivots, are computed once and stored with the parts. Each round
    reads them again: no vector is shuffled. A task sends one row for each entry it used, and codebooks
    hold ``entries`` vectors, whatever the size of the table.
    """
    if not (0 < entries <= 256 and parts > 0 and pivots > 0):
        raise ValueError("a code has one byte a part")
    saved = Saved(vectors.sparkSession, "vector-codes")
    whole = whole_parts(vectors, id_col, vector_col, label_col)
    # Stored first, so that the tasks' smallest rows meet in a task and not on the driver.
    smallest = saved(whole.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries), "first").collect()
    first = [(r.v,) for r in sorted(smallest, key=lambda r: (r.vec_id is None, r.vec_id or 0, r.v))]
    dims = whole.agg(F.max(F.size("v"))).first()[0] or 0
    width = max(1, -(-dims // parts))
    start = np.zeros((len(first), parts * width), np.int64)
    for row, (v,) in zip(start, first, strict=True):
        row[:len(v)] = v
    books = start.reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    kind = "vec_id long, label long, code string, error long"
    if not first:
        return Coded(whole.sparkSession.createDataFrame([], kind), Codebooks(books, books))
    codebooks = Codebooks(books, pivots_of(books, pivots))
    fixed = codebooks.pivots

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, _ROWS):
            flat = _matrix(batch.column(2), parts * width)
            near = pivot_distances(flat.reshape(-1, parts, width).astype(np.int64), fixed)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array([r.tobytes() for r in flat]), pa.array([r.tobytes() for r in near])],
                ["vec_id", "label", "parts", "near"])

    rows = saved(whole.mapInArrow(measured, "vec_id long, label long, parts binary, near binary"), "parts")
    for _ in range(rounds):
        codebooks = _moved(rows, codebooks)
    final = codebooks

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, _ROWS):
            codes, error = np.empty((batch.num_rows, parts), np.uint8), np.zeros(batch.num_rows, np.int64)
            for j, (_, index, apart) in enumerate(_assigned(batch, final)):
                codes[:, j] = index
                error += apart
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array([c.tobytes().hex() for c in codes]), pa.array(error)],
                ["vec_id", "label", "code", "error"])

    return Coded(rows.mapInArrow(coded, kind), final)


def decoded(codes: DataFrame, books: Codebooks, code_col: str = "code") -> DataFrame:
    """The rows with ``vector array<long>``, the entries their codes stand for; a null code gives null."""
    flat = F.array(*(F.array(*(F.lit(int(x)) for x in entry)) for book in books.entries for entry in book))
    parts, count, _ = books.entries.shape
    code = F.col(code_col)
    at = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda j: F.get(flat, j * count + F.conv(
        F.substring(code, j * 2 + 1, 2), 16, 10).cast("int")).cast("array<long>"))
    return codes.withColumn("vector", F.when(code.isNotNull(), F.flatten(at)))
