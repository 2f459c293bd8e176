"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.llm.common import Saved, keep_rows, map_texts
from fareline.llm.components import connected_components

BITS = 64
SEED = 42
# Distinct fingerprints of one bucket that one task compares; larger buckets are cut into blocks.
BLOCK = 4096


def fingerprint(text: str | None, words_each: int) -> int:
    """SimHash of the word shingles, unsigned; zero without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - words_each + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    last = ends[min(words_each, len(words)) - 1:].tolist()
    first = [0, *(ends[:n - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[i:j], SEED) for i, j in zip(first, last, strict=True)), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 8192):  # bounds the unpacked bits of a very long text
        part = hashes[at:at + 8192]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def cover_masks(radius: int) -> list[int]:
    """Bit masks of a covering family: fingerprints within the radius agree under at least one of them.

    Each bit position gets a non-zero vector of radius + 1 bits, and each non-zero vector v of that
    length gives the mask of the positions whose vector has odd product with v. At most ``radius``
    differing positions span less than the whole space, so some v is orthogonal to all of them, and
    its mask leaves them all out. The positions' vectors are spread so that every mask has about half of the bits
    or more: all non-zero vectors in turn where there are no more than positions, else such that end in a one (for
    radius 6 all of these: the first-order Reed-Muller code).
    """
    if not 0 <= radius < BITS:
        raise ValueError(f"radius {radius} outside 0-{BITS - 1}")
    kinds = 2 ** (radius + 1) - 1
    if kinds <= BITS:
        vectors = [1 + i % kinds for i in range(BITS)]
    else:
        vectors = random.Random(radius).sample(range(1 << radius, 2 << radius), BITS)
    return [sum(1 << i for i, x in enumerate(vectors) if (x & v).bit_count() % 2) for v in range(1, kinds + 1)]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def fingerprints(docs: DataFrame, words_each: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp, text_hash)`` of every row; ``fp`` holds the 64 bits as a signed long."""

    def each(ids: list, texts: list) -> dict:
        return {
            "doc_id": ids,
            "fp": np.array([fingerprint(t, words_each) for t in texts], np.uint64).view(np.int64),
            "text_hash": np.array([xxhash.xxh64_intdigest((t or "").encode("utf-8", "replace"), SEED) for t in texts],
                                  np.uint64).view(np.int64)}

    return map_texts(docs, each, "doc_id long, fp long, text_hash long", id_col, text_col)


def spanning_links(fps: np.ndarray, radius: int) -> tuple[list, list]:
    """For all that is connected within the radius, links of its smallest fingerprint (as a signed number) to the others.

    A search from one fingerprint at a time compares it with those not reached yet, so a dense group
    costs about its size and only a group of mutually distant ones its square. The links are stars, which
    the components that are formed of all buckets' links need few rounds for.
    """
    a, b = [], []
    rest = np.sort(fps.view(np.int64)).view(np.uint64)
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        frontier = [root]
        while frontier and len(rest):
            near = np.bitwise_count(rest ^ frontier.pop()) <= radius
            if near.any():
                new = rest[near]
                a.extend([root] * len(new))
                b.extend(new)
                frontier.extend(new)
                rest = rest[~near]
    return a, b


def _bucket_links(radius: int):
    """Arrow function over rows sorted by bucket: links within each bucket."""

    def of_runs(bucket: np.ndarray, fps: np.ndarray) -> pa.RecordBatch | None:
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        sizes = np.diff(np.r_[starts, len(bucket)])
        two = starts[sizes == 2]
        close = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= radius]
        a, b = list(fps[close]), list(fps[close + 1])
        for at, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            x, y = spanning_links(fps[at:at + size], radius)
            a += x
            b += y
        if not a:
            return None
        left, right = np.array(a, np.uint64), np.array(b, np.uint64)
        pairs = np.unique(np.stack([left, right], 1), axis=0)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(pairs[:, i]).view(np.int64)) for i in (0, 1)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_bucket, held_fps = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            bucket = np.concatenate([held_bucket, batch.column(0).to_numpy(zero_copy_only=False)])
            fps = np.concatenate([held_fps, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            if not len(bucket):
                continue
            cut = int(np.searchsorted(bucket, bucket[-1]))  # the last bucket may go on in the next batch
            if cut and (out := of_runs(bucket[:cut], fps[:cut])):
                yield out
            held_bucket, held_fps = bucket[cut:], fps[cut:]
        if len(held_bucket) and (out := of_runs(held_bucket, held_fps)):
            yield out

    return run


def near_links(fps: DataFrame, radius: int = 3, block: int = BLOCK) -> DataFrame:
    """Links ``(a, b)`` whose components are those of all pairs of ``fps(fp)`` within the radius.

    ``fps`` has one row per distinct fingerprint. Each goes to one bucket per mask, where it is compared with what else is
    there. Buckets are counted first: one above ``block`` is cut into blocks that are compared two at a time, each pair of
    blocks in a group of its own, so no task holds more than about two blocks, whatever the bucket's size, and no
    pair within it is missed.
    """
    # A bucket is a hash of mask and masked bits. Two buckets that share it are only compared more than needed, as
    # every comparison is by the bits.
    keyed = fps.select("fp", F.explode(F.array(*(
        F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(F.lit(_signed(m))))
        for t, m in enumerate(cover_masks(radius))))).alias("bucket"))
    sizes = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    large = Saved(fps.sparkSession, "buckets")(sizes.filter(F.col("size") > block), "large")
    if not large.isEmpty():
        blocks = F.coalesce(F.ceil(F.col("size") / block), F.lit(1).cast("long"))
        sized = keyed.join(large, "bucket", "left").withColumn("blocks", blocks)
        own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
        placed = sized.withColumn("own", own).select(
            "bucket", "fp", "own", "blocks",
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
        keyed = placed.select("fp", F.when(F.col("blocks") == 1, F.col("bucket")).otherwise(
            F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other"))).alias("bucket"))
    grouped = keyed.select("bucket", "fp").repartition("bucket").sortWithinPartitions("bucket")
    return grouped.mapInArrow(_bucket_links(radius), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words_each: int = 3, radius: int = 3, id_col: str = "doc_id",
                    text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id, group_fp, text_hash``.

    Words are split at ASCII white space after lower-casing A-Z; a text with fewer words than a shingle
    is one shingle, one without words (empty, null) has fingerprint zero and is linked like any other.
    Documents whose fingerprints differ in at most ``radius`` bits are linked; the component is the
    smallest doc_id reachable. Equal fingerprints count as one node, so copies cost nothing beyond
    their own row. Repeated rows are kept and share a component; a null doc_id never becomes a
    component unless nothing else is reachable (then null). A very long text is fingerprinted whole, its hashes in
    parts of bounded size. An empty table gives an empty result.
    """
    saved = Saved(docs.sparkSession, "simhash")
    marked = saved(fingerprints(docs, words_each, id_col, text_col), "fingerprints")
    nodes = saved(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    found = connected_components(near_links(nodes.select("fp"), radius, block), "simhash-components")
    rooted = nodes.join(found.select(F.col("node").alias("fp"), "component"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.join(least, "root").select("fp", "component_id", F.col("root").alias("group_fp"))
    return marked.join(labels, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "group_fp",
        "text_hash")


def drop_near_duplicates(docs: DataFrame, words_each: int = 3, radius: int = 3) -> DataFrame:
    """One document of each component, all columns kept: the one with the smallest doc_id.

    Null doc_ids come last, equal ones are decided by the hash of their texts, and of rows that repeat
    both id and text one stays. Null and empty texts form one component, as their fingerprints are zero; a very long
    text is fingerprinted whole, its hashes in parts. An empty table gives an empty result.
    """
    marked = near_duplicates(docs, words_each, radius)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "text_hash")).alias("first")
    return keep_rows(docs, marked.groupBy("group_fp").agg(first).select("first.doc_id", "first.text_hash"))
