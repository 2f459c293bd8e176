"""Vector codes against comparing every part with every entry."""

import hashlib
import math
import random

import numpy as np
import pytest
from frames import SF, read

from fareline.llm import vectorcodes
from fareline.llm.queries import op12_vector_codes

SCHEMA = "vec_id long, embedding array<double>, label long"


def plain(rows, parts, entries, rounds):
    """``{(vec_id, label): [(code, error)]}`` and the codebooks, one part and entry after the other."""
    whole = [(i, label, [max(-2**24, min(2**24, math.floor(x * 256))) if abs(x) < 1e300 else int(math.copysign(2**24, x)) for x in v])
             for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(1, -(-max((len(v) for *_, v in whole), default=0) // parts))
    cut = [(i, label, [tuple((v + [0] * parts * width)[j * width:(j + 1) * width]) for j in range(parts)])
           for i, label, v in sorted(whole, key=lambda r: (r[0] is None, r[0] or 0, r[2]))]
    books = [[v[j] for *_, v in cut[:entries]] for j in range(parts)]

    def best(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry, strict=True)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for j, book in enumerate(books):
            groups = {}
            for *_, v in cut:
                groups.setdefault(best(v[j], book)[1], []).append(v[j])
            books[j] = [tuple(sum(x) // len(groups[e]) for x in zip(*groups[e], strict=True)) if e in groups else entry
                        for e, entry in enumerate(book)]
    out = []
    for i, label, v in cut:
        near = [best(v[j], books[j]) for j in range(parts)]
        out.append((i, label, "".join(f"{e:02x}" for _, e in near), sum(d for d, _ in near)))
    return sorted(out, key=str), books


def coded(spark, rows, **options):
    done = vectorcodes.compress(spark.createDataFrame(rows, SCHEMA), **options)
    return sorted((tuple(r) for r in done.rows.select("vec_id", "label", "code", "error").collect()), key=str), done.books


@pytest.mark.parametrize(("parts", "entries", "pivots", "spread"), [(4, 8, 3, 1.0), (2, 5, 9, 0.004), (16, 64, 1, 0.5)])
def test_against_all_comparisons(spark, parts, entries, pivots, spread):
    """Little spread makes many ties; more pivots than entries are all entries."""
    rng = random.Random(entries)
    rows = [(i // 2 if i % 7 == 0 else i, [rng.gauss(0, spread) for _ in range(18)], rng.choice([1, 2, None])) for i in range(300)]
    got, books = coded(spark, rows, parts=parts, entries=entries, pivots=pivots)
    want, want_books = plain(rows, parts, entries, 2)
    assert got == want
    assert books.entries.tolist() == [[list(e) for e in book] for book in want_books]
    assert books.sha256 == hashlib.sha256(",".join(str(x) for b in want_books for e in b for x in e).encode()).hexdigest()


def test_awkward_vectors(spark):
    """Null, non-finite and short vectors, null ids and labels, repeated rows, huge components, no rows at all."""
    rows = [(3, [0.1] * 8, 1), (3, [0.1] * 8, 1), (None, [0.2] * 8, None), (1, None, 1), (2, [0.1, None], 1), (4, [float("nan")], 1),
            (5, [float("inf")] * 8, 1), (6, [0.5, -0.5], None), (7, [], 2), (8, [1e30, -1e300, 70000.0], 2), (9, [-0.001] * 8, 1)]
    got, books = coded(spark, rows, parts=4, entries=3)
    want, want_books = plain(rows, 4, 3, 2)
    assert got == want and books.entries.tolist() == [[list(e) for e in book] for book in want_books]
    for nothing in ([], rows[3:6]):
        done = vectorcodes.compress(spark.createDataFrame(nothing, SCHEMA))
        assert done.rows.collect() == [] and done.books.entries.size == 0
    clashing = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS code", "2 AS error", "3 AS v", "4 AS `Near`")
    assert sorted((tuple(r) for r in vectorcodes.compress(clashing, parts=4, entries=3).rows.select(
        "vec_id", "label", "code", "error").collect()), key=str) == want
    zero = vectorcodes.compress(spark.createDataFrame([(1, [], 1)], SCHEMA)).rows.first()
    assert (zero.code, zero.error) == ("00" * 16, 0)


def test_pivots_spare_most_comparisons(spark):
    vectors = np.array(read(spark, SF, "embeddings").select("embedding").toPandas()["embedding"].tolist())
    parts = np.floor(vectors * 256).astype(np.int64).reshape(len(vectors), 16, 4)
    books = parts[:64].transpose(1, 0, 2).copy()
    pivots = vectorcodes.pivots_of(books, vectorcodes.PIVOTS)
    near = vectorcodes.pivot_distances(parts, pivots)
    count = []
    for j in range(16):
        index, best = vectorcodes.nearest_entries(parts[:, j], near[:, j], books[j], pivots[j], count)
        apart = ((parts[:, j, None] - books[j]) ** 2).sum(-1)
        assert (index == apart.argmin(1)).all() and (best == apart.min(1)).all()
    assert sum(count) < 0.25 * parts.shape[0] * 16 * 64


def test_decoding_gives_back_the_error(spark):
    done = vectorcodes.compress(read(spark, SF, "embeddings"))
    rows = {r.vec_id: r for r in vectorcodes.decoded(done.rows, done.books).collect()}
    for r in read(spark, SF, "embeddings").collect():
        whole = np.floor(np.array(r.embedding) * 256).astype(np.int64)
        assert ((whole - np.array(rows[r.vec_id].vector)) ** 2).sum() == rows[r.vec_id].error


def test_query_sums_errors_of_null_labels_together(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(64)], rng.choice([1, None])) for i in range(200)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = {r.vec_id: r for r in op12_vector_codes(spark, str(tmp_path)).collect()}
    assert len(got) == 200
    for label in (1, None):
        ids = [i for i, _, x in rows if x == label]
        assert {got[i].label_error for i in ids} == {sum(got[i].error for i in ids)}
