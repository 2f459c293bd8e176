"""Exact top-k search by inner product with a three-phase uniform threshold."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareline.llm.common import Saved, pick

SCALE = 1024
# Lists a vector's dimensions are dealt to; each gives a partial score per pair.
LISTS = 2
BLOCK_BYTES = 8 << 20
PACK_QUERIES = 128
# Blocks, of the longest vectors, that give the cutoffs.
FIRST_BLOCKS = 2
_LOWEST = -(1 << 62)


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, v)`` with each component as floor(1024 x), for the vectors that take part."""
    rows = pick(vectors, (id_col, "long", "vec_id"), (vector_col, "array<double>", "v"))
    finite = rows.filter("vec_id IS NOT NULL AND v IS NOT NULL").filter(F.forall("v", lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))))
    return finite.select("vec_id", F.transform("v", lambda x: F.floor(x * SCALE)).alias("v"))


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    """Rows padded with zeros to ``dims``."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dims).all():
        return values.reshape(-1, dims)
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = values
    return out


def _thinned(ids: np.ndarray, rows: np.ndarray, keep: int) -> np.ndarray:
    """Indexes of the ``keep`` smallest ids of each distinct vector; no other can be among the best."""
    order = np.argsort(ids, kind="stable")
    raw = np.ascontiguousarray(rows[order]).view(np.dtype((np.void, rows.shape[1] * 8))).ravel() if rows.shape[1] else \
        np.zeros(len(ids), "V1")
    _, kind = np.unique(raw, return_inverse=True)
    by_kind = np.argsort(kind, kind="stable")
    repeated = np.r_[False, (np.diff(kind[by_kind]) == 0) & (np.diff(ids[order[by_kind]]) == 0)]
    by_kind = by_kind[~repeated]
    first = np.r_[True, np.diff(kind[by_kind]) != 0]
    at = np.arange(len(by_kind))
    nth = at - np.maximum.accumulate(np.where(first, at, 0))
    return order[by_kind[nth < keep]]


def list_norms(data: np.ndarray, lists: int) -> np.ndarray:
    """Euclidean norms of the vectors' parts by list, a little above the true ones."""
    parts = np.array_split(np.arange(data.shape[1]), lists)
    return np.stack([np.sqrt((data[:, p].astype(np.float64) ** 2).sum(1)) for p in parts], 1) * (1 + 1e-9)


def _packs(dims: int, rows: int | None, keep: int | None, lists: int) -> Callable:
    """Arrow function over ``(place, vec_id, v)`` in order of place: a row for each place, or ``rows`` vectors of it,
    with the largest norm of their parts in each list.

    With ``keep``, only so many ids of each distinct vector stay.
    """

    def packed(place: int, nth: int, ids: np.ndarray, data: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "place": pa.array([place], pa.int64()), "nth": pa.array([nth], pa.int64()),
            "ids": pa.array([ids], pa.list_(pa.int64())), "data": pa.array([data.tobytes()], pa.binary()),
            "norms": pa.array([list_norms(data, lists).max(0)], pa.list_(pa.float64()))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, nth, ids, data = None, 0, np.empty(0, np.int64), np.empty((0, dims), np.int64)
        for batch in batches:
            places = batch.column(0).to_numpy(zero_copy_only=False)
            all_ids = batch.column(1).to_numpy(zero_copy_only=False)
            matrix = _matrix(batch.column(2), dims)
            starts = np.flatnonzero(np.r_[True, places[1:] != places[:-1]]) if len(places) else []
            for at, end in zip(starts, [*starts[1:], len(places)], strict=True):
                if places[at] != place:
                    if len(ids):
                        yield packed(place, nth, ids, data)
                    place, nth, ids, data = int(places[at]), 0, np.empty(0, np.int64), np.empty((0, dims), np.int64)
                ids = np.concatenate([ids, all_ids[at:end]])
                data = np.concatenate([data, matrix[at:end]])
                if keep is not None:
                    use = _thinned(ids, data, keep)
                    ids, data = ids[use], data[use]
                while rows and len(ids) >= 2 * rows:
                    yield packed(place, nth, ids[:rows], data[:rows])
                    nth, ids, data = nth + 1, ids[rows:], data[rows:]
        if len(ids):
            yield packed(place, nth, ids, data)

    return run


_PACK = "place long, nth long, ids array<long>, data binary, norms array<double>"
_CUTOFFS = "array<struct<query_id:long,cutoff:long>>"


def _partials(queries: np.ndarray, block: np.ndarray, lists: int) -> list[np.ndarray]:
    """Partial inner products by list; exact, in doubles where these can hold every sum."""
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(block).max(initial=0)) * queries.shape[1]
    kind = np.float64 if bound < 2**53 else np.int64
    parts = np.array_split(np.arange(queries.shape[1]), lists)
    return [queries[:, p].astype(kind) @ block[:, p].astype(kind).T for p in parts]


def _first_phase(k: int, ids: np.ndarray, cutoffs: np.ndarray, own: np.ndarray, partial: list[np.ndarray]) -> list:
    """Exact totals of the heads of the local score lists: the k best of each query."""
    take = min(k + 1, len(ids))
    heads = np.concatenate([np.argpartition(-p, take - 1, axis=1)[:, :take] for p in partial], axis=1)
    rows = []
    for q in range(len(own)):
        at = np.unique(heads[q])
        at = at[ids[at] != own[q]]
        totals = sum(p[q, at] for p in partial)
        best = np.argsort(-totals, kind="stable")[:k]
        rows += [(int(own[q]), int(ids[i]), int(t)) for i, t in zip(at[best], totals[best], strict=True)]
    return rows


def _other_phases(k: int, ids: np.ndarray, cutoffs: np.ndarray, own: np.ndarray, partial: list[np.ndarray]) -> list:
    """Entries some list holds at the uniform cutoff or above, resolved exactly, the k best of each query.

    A total of at least the cutoff has a part of at least the cutoff divided by the number of lists.
    """
    rows = []
    reached = np.zeros(partial[0].shape, bool)
    for p in partial:
        reached |= p * len(partial) >= cutoffs[:, None]
    for q in range(len(own)):
        at = np.flatnonzero(reached[q])
        at = at[ids[at] != own[q]]
        totals = sum(p[q, at] for p in partial)
        enough = totals >= cutoffs[q]
        at, totals = at[enough], totals[enough].astype(np.int64)
        order = np.lexsort((ids[at], -totals))
        _, first = np.unique(ids[at[order]], return_index=True)  # a repeated id counts once, by its best
        best = order[np.sort(first)][:k]
        rows += zip([int(own[q])] * len(best), ids[at[best]].tolist(), totals[best].tolist(), strict=True)
    return rows


def _early(dims: int, keep: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                use = np.sort(_thinned(batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(1), dims), keep))
                yield batch.take(pa.array(use))

    return run


def _told(packs: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """The packs with the cutoffs of their queries and the least of them, null where a query has none."""
    listed = packs.select("place", "nth", F.explode("ids").alias("query_id"))
    told = listed.join(cutoffs, "query_id", "left").groupBy("place", "nth").agg(
        F.collect_list(F.when(F.col("cutoff").isNotNull(), F.struct("query_id", "cutoff"))).alias("cutoffs"),  # of one pack
        F.min("cutoff").alias("least"), F.count_if(F.col("cutoff").isNull()).alias("without"))
    return packs.join(told, ["place", "nth"]).withColumn("least", F.when(F.col("without") == 0, F.col("least")))


def reached_blocks(packs: DataFrame, blocks: DataFrame, places: int) -> DataFrame:
    """``(place, pack_place, pack_nth)``: which block each pack has to meet.

    A score is at most the sum over the lists of the product of two norms. A block in which that is below the cutoffs of all queries of a
    pack holds none of their best. Blocks and packs are compared as their norms here; vectors move for the pairs that are left.
    """
    asked = packs.select(F.col("place").alias("pack_place"), F.col("nth").alias("pack_nth"), "norms", "least", F.explode(
        F.sequence(F.lit(0).cast("long"), F.lit(places - 1).cast("long"))).alias("place"))
    met = asked.join(blocks.select("place", F.col("norms").alias("block_norms")), "place")
    most = F.aggregate(F.zip_with("norms", "block_norms", lambda a, b: a * b), F.lit(0.0), lambda done, x: done + x)
    return met.filter(F.col("least").isNull() | (most + 1 >= F.col("least"))).select("place", "pack_place", "pack_nth")


def _meet(blocks: DataFrame, asked: DataFrame, dims: int, lists: int, k: int, phase: Callable) -> DataFrame:
    """``phase`` for every block of vectors and the packs ``asked`` of it: ``query_id, vec_id, score``.

    A pack follows the block in its partition, so a task holds one block
    and one pack at a time. Cutoffs travel with their pack; a query without one has fewer than k candidates.
    """
    sent = asked.select("place", "pack_place", "pack_nth", "ids", "data", "cutoffs")
    waiting = blocks.select("place", F.lit(-1).cast("long").alias("pack_place"),
                            F.lit(-1).cast("long").alias("pack_nth"), "ids", "data",
                            F.lit(None).cast(_CUTOFFS).alias("cutoffs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = ids = block = norms = None
        for batch in batches:
            for row in range(batch.num_rows):
                own = batch.column(3)[row].values.to_numpy()
                data = np.frombuffer(batch.column(4)[row].as_py(), np.int64).reshape(len(own), dims)
                if batch.column(1)[row].as_py() == -1:
                    place, ids, block = batch.column(0)[row].as_py(), own, data
                    norms = list_norms(block, lists).max(0)
                    continue
                if place != batch.column(0)[row].as_py():
                    continue  # no vector fell to this place
                known = {c["query_id"]: c["cutoff"] for c in batch.column(5)[row].as_py() or () if c is not None}
                limits = np.array([known.get(q, _LOWEST) for q in own.tolist()], np.int64)
                live = (list_norms(data, lists) * norms).sum(1) + 1 >= limits  # the others have no best here
                if not live.any():
                    continue
                own, data, limits = own[live], data[live], limits[live]
                rows = phase(k, ids, limits, own, _partials(data, block, lists))
                if rows:
                    columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    together = waiting.unionByName(sent).repartition("place").sortWithinPartitions(
        "place", "pack_place", "pack_nth")
    return together.mapInArrow(run, "query_id long, vec_id long, score long")


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, lists: int = LISTS, id_col: str = "vec_id",
            vector_col: str = "embedding", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each query's k highest inner products with every other vector: ``query_id, rank, vec_id, score``.

    Components count as floor(1024 x); ties go to the smaller vec_id; a query meets all rows but those of its own
    vec_id, of which the best counts once. Vectors that are null or hold a null or non-finite component, and rows
    without vec_id, take no part; shorter vectors count as padded with zeros. Without queries or
    candidates the result is empty.

    The dimensions are dealt to ``lists`` lists, and vectors to blocks by their norm, the longest first. First the blocks of the
    longest vectors resolve the heads of their local lists, which gives each query k true totals and so a safe cutoff, the k-th of them; then
    the cutoff goes out with the queries, to those blocks only whose norms can reach it; these collect the entries at cutoff / lists
    or above in any list, and resolve those exactly. Blocks and packs of
    queries have a bounded size in bytes. Of identical vectors only the k + 1 smallest ids enter a
    block, because no other can be among a query's best.
    """
    spark = vectors.sparkSession
    saved = Saved(spark, "topk")
    whole = whole_vectors(vectors, id_col, vector_col)
    dims, n = whole.agg(F.coalesce(F.max(F.size("v")), F.lit(0)), F.count(F.lit(1))).first()
    rows = max(64, block_bytes // (8 * max(1, dims)))
    places = max(1, -(-n // rows))
    # Thinned before the shuffle as well, so that a vector a third of the rows share sends k + 1 ids per batch.
    thin = whole.select("vec_id", "v").mapInArrow(
        _early(dims, k + 1), "vec_id long, v array<long>")
    norm = F.aggregate("v", F.lit(0.0), lambda done, x: done + x * x)
    ranged = thin.withColumn("norm", norm).repartitionByRange(places, F.desc("norm"), F.xxhash64("v"))
    # A range is a block; equal vectors have equal norms and hashes and are in one.
    placed = ranged.select(F.spark_partition_id().cast("long").alias("place"), "vec_id", "v")
    blocks = saved(placed.mapInArrow(_packs(dims, None, k + 1, lists), _PACK), "blocks")
    places = (blocks.agg(F.max("place")).first()[0] or 0) + 1
    asked = whole.filter(is_query)
    many = asked.select("vec_id", "v").withColumn("place", F.pmod(F.xxhash64("vec_id"), F.lit(
        max(1, -(-n // (100 * PACK_QUERIES))))))
    # Queries of like norms share a pack, and so have cutoffs that are alike.
    near = many.withColumn("norm", norm).repartition("place").sortWithinPartitions("place", "norm")
    packs = saved(near.select("place", "vec_id", "v").mapInArrow(
        _packs(dims, PACK_QUERIES, None, lists), _PACK), "packs")

    pack = packs.withColumnsRenamed({"place": "pack_place", "nth": "pack_nth"}).drop("norms")
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(min(places, FIRST_BLOCKS) - 1).cast("long")))
    heads = _meet(blocks, pack.withColumns({"place": first, "cutoffs": F.lit(None).cast(_CUTOFFS)}), dims, lists, k, _first_phase)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"))
    heads = heads.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    cutoffs = heads.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") == k).select(
        "query_id", F.col("score").alias("cutoff"))
    told = saved(_told(packs, saved(cutoffs, "cutoffs")), "told")
    pairs = reached_blocks(told, blocks, places)
    limited = told.select(F.col("place").alias("pack_place"), F.col("nth").alias("pack_nth"), "ids", "data", "cutoffs")
    found = _meet(blocks, pairs.join(limited, ["pack_place", "pack_nth"]), dims, lists, k, _other_phases)
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
