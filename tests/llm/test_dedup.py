import hashlib
import random
import re

import pytest
from frames import SF, awkward, documents, groups, read

from fareline.llm import dedup
from fareline.llm.queries import LLM_QUERIES


def plain(rows):
    """``{doc_id: (keep_id, group_size, kept, sha256)}`` of rows with distinct ids."""
    texts = {i: re.sub(r"[\x20\x09-\x0d]+", " ", t or "") for i, t in rows}
    members = groups((t, i) for i, t in texts.items())
    return {i: (min(members[t]), len(members[t]), i == min(members[t]), hashlib.sha256(t.encode()).hexdigest())
            for i, t in texts.items()}


def told(df):
    return {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()}


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, SF).collect()]
    assert told(LLM_QUERIES["op5_exact_dedup"](spark, SF)) == plain(rows)


def test_chunks_depend_on_their_content_only():
    rng = random.Random(1)
    data = bytes(rng.randrange(256) for _ in range(3_000_000))
    parts = dedup.chunks(data)
    assert b"".join(parts) == data and max(map(len, parts)) <= dedup.MOST
    assert min(map(len, parts[:-1])) >= dedup.LEAST
    shifted = dedup.chunks(b"some other beginning" + data)
    assert len(set(parts) & set(shifted)) > 0.95 * len(parts)
    assert dedup.chunks(b"") == [] and dedup.chunks(b"x") == [b"x"]
    flat = b"a" * 100_000
    assert b"".join(dedup.chunks(flat)) == flat


@pytest.mark.parametrize("weak", [lambda c: b"same", lambda c: bytes([len(c) % 2])])
def test_an_identifier_for_two_chunks_is_not_used(spark, weak):
    texts = [f"{i % 7} " + "lorem ipsum " * (300 + i % 7) for i in range(30)]
    docs = documents(spark, *texts)
    assert not dedup.verified(docs, weak, "doc_id", "text")
    assert told(dedup.exact_duplicates(docs, identifiers=(weak, *dedup.IDENTIFIERS))) == plain(enumerate(texts))
    with pytest.raises(ValueError):
        dedup.exact_duplicates(docs, identifiers=(weak,))


def test_white_space_and_case(spark):
    texts = ["a b", "a  b", "a\t\n b", " a b", "a b ", "\n\na b", "A b", "a b", "a\x1fb", "a\x0bb", "", None, " ", "\n"]
    assert told(dedup.exact_duplicates(documents(spark, *texts))) == plain(enumerate(texts))


def test_awkward_rows(spark):
    rows = dedup.exact_duplicates(awkward(spark)).collect()
    assert len(rows) == 10
    by_id = groups((r.doc_id, r) for r in rows)
    assert (by_id[1][0].kept, by_id[2][0].kept, by_id[2][0].keep_id) == (True, False, 1)
    assert sorted(r.kept for r in by_id[4]) == [False, True]
    assert [r.kept for r in by_id[None]] == [False, False]
    kept = dedup.drop_exact_duplicates(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert sorted(r[0] for r in kept.collect()) == [1, 3, 4, 5, 6, 7]


def test_a_repeated_id_with_two_texts(spark):
    docs = documents(spark, (1, "a"), (1, "b"), (2, "a"), (None, "c"), (None, "c"))
    assert sorted((r.doc_id or 0, r.text) for r in dedup.drop_exact_duplicates(docs).collect()) == [
        (0, "c"), (1, "a"), (1, "b")]


def test_empty_table(spark):
    assert dedup.exact_duplicates(documents(spark, "a").filter("false")).count() == 0
