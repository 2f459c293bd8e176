"""Exact deduplication by content-defined chunk recipes."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

import numpy as np
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.llm.common import Saved, keep_rows, map_texts

LEAST, MOST, MEAN = 512, 16384, 2048
WINDOW = 16
_GEAR = np.random.default_rng(20).integers(0, 2**32, 256, np.uint32)
_SEGMENT = 1 << 20
# Chunk digests of one Python task remembered so that a chunk is sent once; forgetting some only sends them again.
_REMEMBERED = 1_000_000

# Identifiers tried in turn, each checked against the bytes of all chunks before its use.
IDENTIFIERS: tuple[Callable[[bytes], bytes], ...] = (
    lambda chunk: xxhash.xxh3_128_digest(chunk),
    lambda chunk: hashlib.sha256(chunk).digest(),
    lambda chunk: hashlib.sha512(chunk).digest(),
)


def normalized(text: str | None) -> bytes:
    """UTF-8 with every run of ASCII white space, also at the ends, as one space."""
    data = (text or "").encode("utf-8", "replace")
    words = data.split()
    if not words:
        return b" " if data else b""
    lead = b" " if data[:1].isspace() else b""
    return lead + b" ".join(words) + (b" " if data[-1:].isspace() else b"")


def _candidates(data: bytes) -> np.ndarray:
    """Ends of chunks the content asks for: a rolling hash of the last 16 bytes has its low bits zero."""
    found = []
    for at in range(0, len(data), _SEGMENT):
        begin = max(0, at - WINDOW)
        h = _GEAR[np.frombuffer(data, np.uint8, min(len(data), at + _SEGMENT) - begin, begin)]
        factor, width = np.uint32(0x9E3779B1), 1
        while width < WINDOW:  # each step doubles the bytes a hash covers
            h[width:] += h[:-width] * factor
            factor, width = np.uint32(int(factor) ** 2 & 0xFFFFFFFF), width * 2
        ends = np.flatnonzero((h >> np.uint32(8)) % np.uint32(MEAN) == 0) + begin + 1
        found.append(ends[ends > at])
    return np.concatenate(found) if found else np.empty(0, np.int64)


def chunks(data: bytes) -> list[bytes]:
    """Chunks that depend on the bytes near their ends only; joined they give the data again."""
    if len(data) <= LEAST:
        return [data] if data else []
    cuts, last = [], 0
    for end in [*_candidates(data).tolist(), len(data)]:
        while end - last > MOST:
            last += MOST
            cuts.append(last)
        if end - last >= LEAST and end < len(data):
            cuts.append(end)
            last = end
    return [data[i:j] for i, j in zip([0, *cuts], [*cuts, len(data)], strict=True) if j > i]


def _contents(docs: DataFrame, identify: Callable[[bytes], bytes], id_col: str, text_col: str) -> DataFrame:
    """``(id, content)`` of the chunks; each is sent about once per task, however often it occurs there."""
    sent: set[bytes] = set()

    def each(ids: list, texts: list) -> dict:
        if len(sent) > _REMEMBERED:
            sent.clear()
        fresh: dict[bytes, bytes] = {}
        for text in texts:
            for chunk in chunks(normalized(text)):
                # Remembered by content digest: a chunk that shares its identifier with another is still sent.
                seen = hashlib.sha256(chunk).digest()
                if seen not in sent:
                    sent.add(seen)
                    fresh[seen] = chunk
        found = list(fresh.values())
        return {"id": [identify(c) for c in found], "content": found}

    return map_texts(docs, each, "id binary, content binary", id_col, text_col)


def verified(docs: DataFrame, identify: Callable[[bytes], bytes], id_col: str, text_col: str) -> bool:
    """Whether no identifier stands for two different chunks, found by comparing the bytes.

    Every distinct chunk moves once, to its identifier's partition; documents do not.
    """
    distinct = _contents(docs, identify, id_col, text_col).repartition("id").dropDuplicates(["id", "content"])
    clashes = distinct.groupBy("id").agg(F.count(F.lit(1)).alias("contents")).filter("contents > 1")
    return clashes.isEmpty()


def recipes(docs: DataFrame, identify: Callable[[bytes], bytes], id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``(doc_id, row, text_sha256, text_hash, recipe)``: the recipe is the text's chunk identifiers in order."""

    first = [0]

    def each(ids: list, texts: list) -> dict:
        context = TaskContext.get()
        base = (context.partitionId() << 33) + first[0]
        first[0] += len(ids)
        out: dict = {"doc_id": ids, "row": range(base, base + len(ids)), "text_sha256": [], "text_hash": [],
                     "recipe": []}
        for text in texts:
            data = normalized(text)
            out["text_sha256"].append(hashlib.sha256(data).hexdigest())
            hashed = xxhash.xxh64_intdigest((text or "").encode("utf-8", "replace"), 42)
            out["text_hash"].append(hashed - (1 << 64) if hashed >> 63 else hashed)
            out["recipe"].append(b"".join(map(identify, chunks(data))))
        return out

    return map_texts(docs, each, "doc_id long, row long, text_sha256 string, text_hash long, recipe binary",
                     id_col, text_col)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     identifiers: Sequence[Callable[[bytes], bytes]] = IDENTIFIERS) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256, text_hash``.

    Texts are equal when identical after each run of ASCII white space became one space; null counts
    as empty. Texts are cut where their content asks for it and compared as ordered lists of chunk identifiers,
    which stand for the chunks because those were compared byte by byte first; if two chunks share an identifier,
    the next identifier of the list is used for all. Of equal texts the row with the smallest doc_id stays, a null
    doc_id only if no other is there (then keep_id is null), and of rows that repeat the smallest doc_id exactly
    one. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    for identify in identifiers:
        if verified(docs, identify, id_col, text_col):
            break
    else:
        raise ValueError("every identifier stands for two different chunks")
    saved = Saved(spark, "recipes")
    told = saved(recipes(docs, identify, id_col, text_col), "recipes")
    stays = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row")).alias("stays")
    # Stored, so that the join has a shuffle on either side and can be split where a third of the rows are copies.
    groups = saved(told.groupBy("recipe").agg(stays, F.count(F.lit(1)).alias("group_size")), "groups")
    return told.join(groups, "recipe").select(
        "doc_id", F.col("stays.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("stays.row")).alias("kept"), "text_sha256", "text_hash")


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    return keep_rows(docs, exact_duplicates(docs).filter("kept"))
