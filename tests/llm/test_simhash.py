import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from frames import SF, awkward, documents, groups, read
from pyspark.sql import functions as F

from fareline.llm import simhash
from fareline.llm.queries import LLM_QUERIES


def plain_fingerprint(text, words_each):
    words = [w for w in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode().lower()) if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + words_each]) for i in range(max(1, len(words) - words_each + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(fps, radius):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= radius:
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("radius", [0, 1, 3, 5, 6, 8])
def test_every_pair_within_the_radius_shares_a_mask(radius):
    masks, rng = simhash.cover_masks(radius), random.Random(radius)
    assert len(masks) == len(set(masks)) == 2 ** (radius + 1) - 1
    assert radius > 6 or min(m.bit_count() for m in masks) >= 32  # else buckets would be few and large
    cases = itertools.combinations(range(64), radius) if radius <= 3 else (
        rng.sample(range(64), radius) for _ in range(20_000))
    for bits in cases:
        difference = sum(1 << b for b in bits)
        assert any(not difference & m for m in masks)


def test_query_against_brute_force(spark):
    rows = sorted(read(spark, SF).select("doc_id", "text").collect())
    fps = [plain_fingerprint(r.text, 3) for r in rows]
    roots = plain_components(fps, 3)
    expected = {r.doc_id: (f"{fp:016x}", rows[root].doc_id) for r, fp, root in zip(rows, fps, roots, strict=True)}
    assert {r[0]: tuple(r[1:]) for r in LLM_QUERIES["op1_simhash"](spark, SF).collect()} == expected


@pytest.mark.parametrize("block", [3, 4096])
def test_links_of_a_dense_bucket_in_blocks(spark, block):
    """Fingerprints around a few centres, so that buckets are far above the block size."""
    rng = random.Random(7)
    centres = [rng.getrandbits(64) for _ in range(4)]
    fps = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for c in centres for _ in range(60)}
    fps = sorted(fps)
    frame = spark.createDataFrame([(fp - (1 << 64) if fp >> 63 else fp,) for fp in fps], "fp long")
    links = [(a % (1 << 64), b % (1 << 64)) for a, b in simhash.near_links(frame, 3, block).collect()]
    assert {x for link in links for x in link} <= set(fps)
    parent = {fp: fp for fp in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert [find(fp) for fp in fps] == [fps[i] for i in plain_components(fps, 3)]


def test_long_text_equals_plain_form():
    text = " ".join(random.Random(3).choice(("alpha", "beta", "Gamma", "delta")) for _ in range(20_000))
    assert simhash.fingerprint(text, 3) == plain_fingerprint(text, 3)


def test_awkward_rows(spark):
    rows = simhash.near_duplicates(awkward(spark)).collect()
    assert len(rows) == 10
    by_id = groups((r.doc_id, r) for r in rows)
    assert by_id[1][0].fingerprint == by_id[2][0].fingerprint == by_id[3][0].fingerprint == "0" * 16
    assert {r.component_id for r in (*by_id[1], *by_id[2], *by_id[3])} == {1}
    assert [r.component_id for r in by_id[4]] == [4, 4]
    assert sorted(r.component_id for r in by_id[None]) == [1, 4]
    kept = simhash.drop_near_duplicates(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert sorted(r[0] for r in kept.collect()) == [1, 4, 5, 6, 7]


def test_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, "a").filter("false")).count() == 0
    assert simhash.drop_near_duplicates(documents(spark, "a").filter("false")).count() == 0


def test_only_null_ids(spark):
    docs = documents(spark, (None, "a b c d e"), (None, "a b c d e"), (None, "z y x w v"))
    assert simhash.drop_near_duplicates(docs).count() == 2
    assert {r.component_id for r in simhash.near_duplicates(docs).collect()} == {None}


def test_fingerprints_as_longs_keep_all_bits(spark):
    marked = simhash.fingerprints(read(spark, SF)).select("fp", F.hex("fp").alias("h")).collect()
    assert any(r.fp < 0 for r in marked)
    assert all(int(r.h, 16) == r.fp % (1 << 64) for r in marked)
    assert np.int64(-1).view(np.uint64) == 2 ** 64 - 1
