"""Small frames that hold the awkward cases: nulls, empty and long texts, repeated rows, clashing names."""

from collections import defaultdict

SF = "/root/testdata/sf0.001"

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, *texts):
    """One row per text, or per (doc_id, text)."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, None, None, None if t is None else len(t)) for i, t in rows], SCHEMA)


def awkward(spark):
    """Null and empty texts, white space only, repeated rows, null ids, a long text, and columns with clashing names."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    docs = documents(spark, (1, None), (2, ""), (3, " \n"), (4, "one two three"), (4, "one two three"), (None, "one two three"),
                     (None, None), (5, long), (6, "Ünïcode 𝒳 text\x00with controls"), (7, "x" * 5000))
    columns = ("TEXT", "fingerprint", "component_id", "kept", "score", "ids", "start", "row.hash", "c0", "fp")
    for i, name in enumerate(columns):
        docs = docs.selectExpr("*", f"{i} AS `{name}`")
    return docs


def read(spark, sf_dir, name="documents"):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def groups(pairs):
    out = defaultdict(list)
    for key, value in pairs:
        out[key].append(value)
    return out
