"""The text operators as queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.llm import conversations, dedup, htmltext, language, packing, pieces, pii, quality, secrets, simhash, topk, urls, vectorcodes
from fareline.llm.common import Saved, table

URL_RULES = (
    urls.Rule("block", "net", "/"),
    urls.Rule("allow", "example.net", "/en/"),
    urls.Rule("block", "example.com", "/de/"),
    urls.Rule("allow", "org", "/fr/"),
)

# A key of the test tables only; a user passes a secret one.
PSEUDONYM_KEY = b"key of the test tables"


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words_each=3, radius=3).select(
        "doc_id", "fingerprint", "component_id")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.encode_and_decode(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def remainder(parts: int) -> Column:
    """The fold of a document: crc32 of its doc_id as text, modulo ``parts``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs, usable=remainder(4) != 2)
    held_out = F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out")
    return language.identify(docs, model).select("doc_id", held_out, "lang_pred", "score")


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.QualityModel:
    return quality.fit(docs, table(spark, sf_dir, "labels"), usable=remainder(3) != 1)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out")
    return quality.score(docs, quality_model(spark, docs, sf_dir)).select(
        "doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pseudonymize(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)
    return found.select("doc_id", "text", F.size("found").cast("long").alias("n_replaced"), F.array_join(F.transform(
        "found", lambda v: F.concat_ws(":", v.kind, v.start, v.end)), ",").alias("spans"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), digest=True)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES).drop("component")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))

    def joined(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *(count(kind) for kind in secrets.KINDS),
                        F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return htmltext.extract(pages, htmltext.fit(pages)).withColumn("n_chars", F.length("text").cast("long"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vectorcodes.compress(table(spark, sf_dir, "embeddings"))
    rows = Saved(spark, "vector-codes")(coded.rows, "codes")
    total = rows.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error"))
    return rows.join(total, F.col("label").eqNullSafe(F.col("same"))).select(
        "vec_id", "code", "error", "label_error", F.lit(coded.books.sha256).alias("codebooks_sha256"))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, n`` of conversations with faults made by a checksum of conv_id and turn; null is a space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    fault = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return conversations.select(
        "conv_id", "turn", F.when(fault == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).cast("long").alias("n"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    repaired = conversations.repair(damaged(table(spark, sf_dir, "conversations")))
    reports, digests = repaired.reports.alias("r"), repaired.digests().alias("d")
    return reports.join(digests, F.col("r.conv_id").eqNullSafe(F.col("d.conv_id")), "left").select(
        "r.*", F.coalesce("d.sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_language": op3_language,
    "op4_topk": op4_topk,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_quality": op6_quality,
    "op7_pseudonyms": op7_pseudonyms,
    "op8_packing": op8_packing,
    "op9_url_filter": op9_url_filter,
    "op10_secrets": op10_secrets,
    "op11_html_text": op11_html_text,
    "op12_vector_codes": op12_vector_codes,
    "op13_conversation_repair": op13_conversation_repair,
}
