"""The pipeline stage by stage against plain forms of the stages, and its registration."""

import os
import subprocess
import sys

import corpus_pipeline
from frames import SF, awkward, documents, read

import __spark_entry__ as entry_point
from fareline.llm import quality, secrets, simhash
from fareline.llm.queries import LLM_QUERIES, quality_model
from fareline.sources import scratch

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages_over_a_table(spark, tmp_path):
    docs = read(spark, SF)
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, SF)
        if name != "packing":
            assert result.schema.names == docs.schema.names
        result.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        found[name] = docs.collect()
    kept = {name: {r.doc_id for r in rows} for name, rows in found.items()}
    scorer = quality.Scorer(quality_model(spark, read(spark, SF), SF))
    ids = list(texts)
    good = {i for i, s in zip(ids, scorer.scores([texts[i] for i in ids]), strict=True) if s >= 0.5}
    assert kept["quality_classifier"] == good
    first = {}
    for i in sorted(good):
        first.setdefault(" ".join((texts[i] or "").split()), i)
    assert kept["exact_dedup"] == set(first.values())
    fps = {i: simhash.fingerprint(texts[i], 3) for i in sorted(first.values())}
    left, groups = set(fps), []
    while left:
        group, frontier = set(), [min(left)]
        while frontier:
            at = frontier.pop()
            group.add(at)
            frontier += [i for i in left - group if (fps[i] ^ fps[at]).bit_count() <= 3]
        groups.append(min(group))
        left -= group
    assert kept["simhash_near_dedup"] == set(groups) == kept["secret_scan"] == kept["packing"]
    for r in found["secret_scan"]:
        assert r.text == secrets.masked(texts[r.doc_id], secrets.all_spans(texts[r.doc_id]))
        assert r.n_chars == len(r.text)
    assert [tuple(r) for r in sorted(corpus_pipeline.run(spark, SF).select("doc_id", "start", "length").collect())] == sorted(
        (r.doc_id, r.start, r.length) for r in found["packing"])


def test_stages_over_awkward_rows_and_an_empty_table(spark):
    for docs in (awkward(spark), documents(spark, "a").filter("false")):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            assert name == "packing" or docs.columns == columns
        docs.collect()


def test_scratch_tables_of_stages_are_deleted(spark):
    """Of a run only the input of its last stage stays."""
    made = []
    scratch._scopes.append(made)
    try:
        packed = corpus_pipeline.run(spark, SF)
    finally:
        scratch._scopes.remove(made)
    left = [path for path in (m.removeprefix("file://") for m in made) if os.path.isdir(path)]
    assert len(made) > 5 and len(left) == 1 and os.listdir(left[0]) == ["secret_scan"]
    assert packed.count() > 0


def test_registration():
    queries = entry_point.queries()
    assert {name.split("_")[0] for name in LLM_QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(LLM_QUERIES) | {"pipeline"} <= set(queries)
    assert set(entry_point.oracle_sql()) <= set(queries)


def test_the_rest_does_without_the_text_operators():
    """Nothing outside imports them, and the entry point works where they cannot be imported."""
    code = ("import sys; sys.modules['corpus_pipeline'] = None\n"
            "import __spark_entry__ as e\n"
            "assert not [n for n in e.queries() if n.startswith('op') and n[2].isdigit()] and 'pipeline' not in e.queries()\n"
            "assert not [m for m in sys.modules if m.startswith('fareline.llm')]")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
    missing = code.split("\n", 1)[0].replace("corpus_pipeline", "xxhash") + "\n" + "\n".join(code.split("\n")[1:3])
    subprocess.run([sys.executable, "-c", missing], cwd=ROOT, check=True)
