"""Language and quality: held-out accuracy and awkward rows."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from frames import SF, awkward, documents, groups, read
from pyspark.sql import functions as F

from fareline.llm import language, quality
from fareline.llm.queries import LLM_QUERIES, remainder

SF_LARGER = "/root/testdata/sf0.01"


def fold(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


def test_language_query_on_held_out_rows(spark):
    truth = {r.doc_id: r.lang for r in read(spark, SF_LARGER).collect()}
    rows = LLM_QUERIES["op3_language"](spark, SF_LARGER).collect()
    assert {r.doc_id for r in rows} == set(truth) and len(rows) == len(truth)
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97


def test_backoff_takes_shorter_grams_for_unseen_words():
    def table(**rows):
        return language.Table({key: i for i, key in enumerate(rows)}, np.array(list(rows.values())).reshape(-1, 2))

    model = language.LanguageModel(("a", "b"), table(known=[-1.0, -2.0]), (
        table(k=[-1.0, -1.5], z=[-3.0, -1.0]), table(**{"<k": [-1.0, -4.0]}), table(), table(knew=[-5.0, -1.0])))
    found = language.Identifier(model)
    assert found.evidence("known").tolist() == [-1, -2]
    assert found.evidence("knew").tolist() == [-5, -1]
    assert found.evidence("kxx").tolist() == [-1, -4]
    assert found.evidence("zz").tolist() == [-3, -1]
    assert found.evidence("qq").tolist() == [0, 0]
    assert found.predict("zz zz")[0] == "b" and found.predict("known")[0] == "a"
    assert found.predict("qq") == ("a", 0.5)


def test_language_of_awkward_rows(spark):
    model = language.fit(read(spark, SF))
    by_id = groups((r.doc_id, r) for r in language.identify(awkward(spark), model).collect())
    for i in (1, 2, 3):
        assert (by_id[i][0].lang_pred, by_id[i][0].score) == ("und", 0.0)
    assert len(by_id[4]) == len(by_id[None]) == 2
    only = documents(spark, "123 456 ²³ !?", "٣٤")
    assert {r.lang_pred for r in language.identify(only, model).collect()} == {"und"}


def test_nothing_to_learn_from(spark):
    model = language.fit(documents(spark, "some text").filter("false"))
    assert model.languages == ()
    assert language.identify(documents(spark, "some text"), model).first().lang_pred == "und"
    assert language.fit(documents(spark, "lang is null here")).languages == ()


def test_quality_query_on_held_out_rows(spark):
    truth = {r.doc_id: r.quality for r in read(spark, SF_LARGER, "labels").collect()}
    rows = LLM_QUERIES["op6_quality"](spark, SF_LARGER).collect()
    assert len(rows) == 1000
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
               for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.93
    assert np.mean([r.predicted for r in held if truth[r.doc_id] == 1]) > 0.97


def test_a_label_of_held_out_rows_changes_nothing(spark):
    docs, labels = read(spark, SF), read(spark, SF, "labels")
    flipped = labels.withColumn("quality", F.when(remainder(3) == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, other = (quality.fit(docs, told, usable=remainder(3) != 1) for told in (labels, flipped))
    assert one == other


def test_fit_without_one_label(spark):
    docs = documents(spark, "a b c", "d e f")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    ones = spark.createDataFrame([(0, 1, 0), (1, 1, None), (1, None, 0), (None, 0, 0), (0, 7, 0)], none.schema)
    for labels, expected in ((none, 0.5), (ones, 1.0)):
        model = quality.fit(docs, labels)
        assert {r.score for r in quality.score(docs, model).collect()} == {expected}


@pytest.fixture(scope="module")
def model(spark):
    return quality.fit(read(spark, SF_LARGER), read(spark, SF_LARGER, "labels"))


def test_quality_of_awkward_rows(spark, model):
    by_id = groups((r.doc_id, r.score) for r in quality.score(awkward(spark), model).collect())
    assert sum(map(len, by_id.values())) == 10 and all(0 <= s <= 1 for v in by_id.values() for s in v)
    assert by_id[1] == by_id[2] and by_id[4][0] == by_id[4][1]
    kept = quality.keep_good(awkward(spark), model)
    assert kept.columns == awkward(spark).columns
    assert sorted(r[0] or -1 for r in kept.collect()) == sorted(
        i or -1 for i, scores in by_id.items() for s in scores if s >= 0.5)
    assert quality.score(documents(spark, "a").filter("false"), model).count() == 0


# --- plain forms, a word or a text at a time ---
def plain_language(rows, texts):
    """Predictions of ``texts`` by counts over all of ``rows`` (text, lang), scored word by word."""
    languages = sorted({lang for _, lang in rows})
    words, pieces = {}, {}
    for text, lang in rows:
        for word in re.findall(r"[^\W\d_]+", text.lower()):
            words.setdefault(word, Counter())[lang] += 1
            for size in range(1, 5):
                marked = f"<{word}>" if size > 1 else word
                for i in range(len(marked) - size + 1):
                    pieces.setdefault(size, {}).setdefault(marked[i:i + size], Counter())[lang] += 1

    def total(table, lang):
        return sum(n[lang] + 0.5 for n in table.values())

    sums = {(size, lang): total(table, lang) for size, table in [(0, words), *pieces.items()] for lang in languages}

    def evidence(word):
        if word in words:
            return [math.log((words[word][lang] + 0.5) / sums[0, lang]) for lang in languages]
        for size in range(4, 0, -1):
            marked = f"<{word}>" if size > 1 else word
            known = [pieces[size][g] for i in range(len(marked) - size + 1) if (g := marked[i:i + size]) in pieces.get(size, {})]
            if known:
                return [sum(math.log((n[lang] + 0.5) / sums[size, lang]) for n in known) / len(known) for lang in languages]
        return [0.0] * len(languages)

    out = []
    for text in texts:
        found = re.findall(r"[^\W\d_]+", (text or "").lower())
        if not found:
            out.append(("und", 0.0))
            continue
        scores = [sum(s) for s in zip(*map(evidence, found), strict=True)]
        best = max(scores)
        out.append((languages[scores.index(best)], 1 / sum(math.exp((s - best) / math.sqrt(len(found))) for s in scores)))
    return out


def test_language_against_a_plain_form(spark):
    """All rows are learned from where there are fewer than the bound, whatever their number of languages."""
    rows = [(r.text, r.lang) for r in read(spark, SF).collect()] + [(f"zz{i} word{i}", f"l{i}") for i in range(300)]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert len(model.languages) >= 304 and "zz7" not in model.words.keys  # letters only
    asked = [r[0] for r in rows[:40]] + [None, "", "12", "qqxzzqy wxyz", "the unseenword", "zz word"]
    found = sorted(language.identify(documents(spark, *asked), model).collect())
    for r, (lang, score) in zip(found, plain_language(rows, asked), strict=True):
        assert r.lang_pred == lang and math.isclose(r.score, score, rel_tol=1e-6)


def plain_quality(rows, texts):
    """Scores by the same dictionaries and a calibration by plain gradient steps, to a loose tolerance."""
    def crc(text):
        return zlib.crc32(text.encode())

    parts = {side: sorted({(crc(t), t, label) for t, label in rows if crc(t) % 2 == side}) for side in (0, 1)}
    dictionaries = []
    for wanted in (1, 0):
        mine = [(c, t.encode()) for c, t, label in parts[1] if label == wanted]
        rate = min(1.0, quality.DICTIONARY_BYTES / sum(len(t) for _, t in mine))
        dictionaries.append(b"\n".join(t[i * 256:(i + 1) * 256] for c, t in mine for i in range(max(1, -(-len(t) // 256)))
                                       if i == c % max(1, -(-len(t) // 256)) or zlib.crc32(f"{c}:{i}".encode()) < rate * 2**32))

    def sizes(text):
        data = (text or "").encode()
        found = []
        for content in (*dictionaries, None):
            options = {"dict_data": zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)} if content else {}
            found.append(len(zstandard.ZstdCompressor(level=3, **options).compress(data)))
        good, bad, plain = found
        n = max(1, len(data))
        return [(good - bad) / max(good, bad), good / n, plain / n, math.log(n)]

    check = np.array([sizes(t) for _, t, _ in parts[0]])
    low, high = check.min(0), check.max(0)

    def terms(x):
        x = [v * k for v, k in zip(x, (8, 4, 4, 1 / 8), strict=True)]
        return [1.0, *x, *(x[i] * x[j] for i in range(4) for j in range(i, 4))]

    a, y = np.array([terms(x) for x in check]), np.array([label for *_, label in parts[0]], float)
    w = np.zeros(a.shape[1])
    for _ in range(400):  # Newton steps without any safeguard but a small size
        p = 1 / (1 + np.exp(-a @ w))
        w -= 0.2 * np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 0.05 * np.eye(len(w)), a.T @ (p - y) + 0.05 * w)
    return [1 / (1 + math.exp(-float(np.array(terms(np.clip(sizes(t), low, high))) @ w))) for t in texts]


def test_quality_against_a_plain_form(spark):
    docs, labels = read(spark, SF_LARGER), read(spark, SF_LARGER, "labels")
    long = " ".join(f"A sentence about number {i} that is longer than any other." for i in range(4000))
    more = docs.limit(1).withColumns({"doc_id": F.lit(10**6).cast("long"), "text": F.lit(long)})
    docs = docs.unionByName(more)
    labels = labels.unionByName(labels.limit(1).withColumns({"doc_id": F.lit(10**6).cast("long"), "quality": F.lit(1)}))
    rows = [(r.text, r.quality) for r in docs.join(labels, "doc_id").filter("text IS NOT NULL AND quality IN (0, 1)").collect()]
    asked = [rows[i][0] for i in range(0, 60, 3)] + [None, "", long, "x"]
    model = quality.fit(docs, labels)
    assert model.high[3] == pytest.approx(math.log(len(long))) or zlib.crc32(long.encode()) % 2 == 1
    found = [r.score for r in sorted(quality.score(documents(spark, *asked), model).collect())]
    assert np.allclose(found, plain_quality(rows, asked), atol=1e-3)


def test_chunks_come_from_all_positions_of_every_text():
    for n in (0, 1, 256, 257, 10_000):
        for rate in (0.0, 0.1, 1.0):
            chosen = quality.chosen_chunks(b"x" * n, 12345, rate)
            assert len(chosen) >= 1 and (rate < 1 or chosen == list(range(max(1, -(-n // 256)))))
    far = [i for crc in range(300) for i in quality.chosen_chunks(b"x" * 25_600, crc, 0.2)]
    assert min(far) < 5 and max(far) > 95 and abs(np.mean(far) - 49.5) < 3


def test_many_models_in_one_session(spark):
    """Workers that are used again score with the model they are given, not with one before it."""
    for i in range(20):
        words = ("aaa bbb", "ccc ddd") if i % 2 else ("ccc ddd", "aaa bbb")
        docs = spark.createDataFrame([(1, words[0], "x"), (2, words[1], "y")], "doc_id long, text string, lang string")
        told = {r.doc_id: r.lang_pred for r in language.identify(docs, language.fit(docs)).collect()}
        assert told == {1: "x", 2: "y"}
    texts = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    for i in range(20):
        model = quality.QualityModel(b"", b"", (), (), (), i / 20)
        assert quality.score(texts, model).first().score == i / 20


def test_a_text_column_in_another_case(spark, model):
    docs = documents(spark, "some words", None).withColumnRenamed("text", "Text")
    assert quality.keep_good(docs, model).columns == docs.columns
    assert quality.score(docs, model).count() == 2
