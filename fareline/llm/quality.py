"""Quality scores from how well texts compress against good and bad examples."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from fareline.llm.common import Saved, map_texts, pick, place_of, slices, texts_of

# Bound of the fit: documents per label that it learns from, on average.
SAMPLE_PER_LABEL = 2500
# Size of the model: bytes of a dictionary, made of chunks from all over the sampled texts.
DICTIONARY_BYTES = 1 << 19
CHUNK_BYTES = 256
LEVEL = 3
_GRAIN = 1 << 20


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries of good and bad text, and the calibration of what they save."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    low: tuple[float, ...]
    high: tuple[float, ...]
    prior: float


class Scorer:
    """Compressors of one model; made once per Python worker."""

    _made: dict[str, Scorer] = {}

    def __init__(self, model: QualityModel):
        self.model = model
        self.compressors = []
        for content in (model.good, model.bad, b""):
            if content:
                shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                shared.precompute_compress(level=LEVEL)
                self.compressors.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=shared))
            else:
                self.compressors.append(zstandard.ZstdCompressor(level=LEVEL))

    @classmethod
    def of(cls, key: str, model: QualityModel) -> Scorer:
        """The one of this worker for ``key``, which no other use of a model has."""
        if key not in cls._made:
            cls._made.clear()
            cls._made[key] = cls(model)
        return cls._made[key]

    def sizes(self, text: str | None) -> tuple[float, ...]:
        """Normalised compressed sizes: good against bad, good and plain per byte, and the log of the length."""
        data = (text or "").encode("utf-8", "replace")
        good, bad, plain = (len(c.compress(data)) for c in self.compressors)
        n = max(1, len(data))
        return (good - bad) / max(good, bad), good / n, plain / n, float(np.log(n))

    def scores(self, texts: list) -> np.ndarray:
        if not self.model.weights:
            return np.full(len(texts), self.model.prior)
        raw = np.array([self.sizes(t) for t in texts]).reshape(-1, 4)
        return _logistic(_terms(np.clip(raw, self.model.low, self.model.high)) @ np.array(self.model.weights))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _terms(raw: np.ndarray) -> np.ndarray:
    """The sizes, their squares and products, scaled to about one."""
    x = raw * np.array([8, 4, 4, 1 / 8])
    pairs = [x[:, i] * x[:, j] for i in range(4) for j in range(i, 4)]
    return np.column_stack([np.ones(len(x)), x, *pairs])


def _calibrated(terms: np.ndarray, labels: np.ndarray, penalty: float = 5e-2) -> np.ndarray:
    """Ridge logistic regression by Newton steps, each halved until it lowers the loss."""

    def loss(w: np.ndarray) -> float:
        x = terms @ w
        return float(np.logaddexp(0, np.where(labels == 1, -x, x)).sum() + penalty / 2 * w @ w)

    weights, now = np.zeros(terms.shape[1]), np.inf
    for _ in range(100):
        before, now = now, loss(weights)
        if before - now < 1e-7:
            break
        p = _logistic(terms @ weights)
        curve = (terms * (p * (1 - p))[:, None]).T @ terms + penalty * np.eye(len(weights))
        step = np.linalg.solve(curve, terms.T @ (p - labels) + penalty * weights)
        size = 1.0
        while size > 1e-6 and loss(weights - size * step) >= now:
            size /= 2
        weights = weights - size * step
    return weights


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None, per_label: int = SAMPLE_PER_LABEL,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> QualityModel:
    """A model from about ``per_label`` documents of each label, drawn by a hash of the doc_id, their whole texts.

    ``usable`` is a condition on ``doc_id``. Labels other than 0 and 1 and contradictory labels of one document are not used. Half of the
    sample (by a hash of the text, so that copies stay together) makes the dictionaries, of chunks from all positions of all
    its texts, each text in proportion to its length and with one chunk at least. The other half calibrates. Neither half's texts reach
    the driver, only the chunks and four numbers a document. With no document of either label in a half the score is the
    share of label 1 for every text, 0.5 without any label.
    """
    told = pick(labels, (id_col, "long", "doc_id"), (label_col, "int", "label")).filter("label IN (0, 1)")
    if usable is not None:
        told = told.filter(usable)
    agreed = told.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).filter(
        "label = most AND doc_id IS NOT NULL")
    counts = dict(agreed.groupBy("label").count().collect())
    share = {label: min(1.0, per_label / n) for label, n in counts.items()}
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(_GRAIN)) < F.when(
        F.col("label") == 1, int(share.get(1, 0) * _GRAIN)).otherwise(int(share.get(0, 0) * _GRAIN))
    # About twice ``per_label`` ids, whatever the size of the tables.
    met = texts_of(docs, id_col, text_col).filter("text IS NOT NULL").join(
        F.broadcast(agreed.filter(drawn).select("doc_id", "label")), "doc_id")
    saved = Saved(docs.sparkSession, "quality")
    sample = saved(met.select("text", "label", F.crc32(F.col("text").cast("binary")).alias("crc")).distinct(), "sample")
    learn, check = sample.filter("crc % 2 = 1"), sample.filter("crc % 2 = 0")
    total = sum(counts.values())
    prior = counts.get(1, 0) / total if total else 0.5
    sizes = {r.label: r.size for r in learn.groupBy("label").agg(F.sum(F.octet_length("text")).alias("size")).collect()}
    if set(sizes) != {0, 1} or check.select("label").distinct().count() != 2:
        return QualityModel(b"", b"", (), (), (), prior)
    rates = {label: DICTIONARY_BYTES / max(DICTIONARY_BYTES, size) for label, size in sizes.items()}
    chunks = learn.select("crc", "text", "label").mapInArrow(_chosen(rates), "label int, crc long, nth int, chunk binary").collect()
    good, bad = (b"\n".join(r.chunk for r in sorted(chunks, key=lambda r: (r.crc, r.nth, r.chunk)) if r.label == wanted)
                 for wanted in (1, 0))
    unfitted = QualityModel(good, bad, (), (), (), prior)
    measured = sorted(tuple(r) for r in _measured(check, unfitted).collect())
    raw = np.array([r[1:] for r in measured])
    weights = _calibrated(_terms(raw), np.array([r[0] for r in measured], float))
    return QualityModel(good, bad, tuple(weights), tuple(raw.min(0)), tuple(raw.max(0)), prior)


def chosen_chunks(data: bytes, crc: int, rate: float) -> list[int]:
    """Which chunks of a text enter the dictionary: a share of them from all positions, by a hash, and one at least."""
    n = max(1, -(-len(data) // CHUNK_BYTES))
    always = crc % n
    return [i for i in range(n) if i == always or zlib.crc32(b"%d:%d" % (crc, i)) < rate * 2**32]


def _chosen(rates: dict[int, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for crc, text, label in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = text.encode("utf-8", "replace")
                rows += [(label, crc, i, data[i * CHUNK_BYTES:(i + 1) * CHUNK_BYTES]) for i in chosen_chunks(data, crc, rates[label])]
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
                columns, (pa.int32(), pa.int64(), pa.int32(), pa.binary()), strict=True)], ["label", "crc", "nth", "chunk"])

    return run


def _measured(rows: DataFrame, model: QualityModel) -> DataFrame:
    """Label and sizes of each text."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scorer = Scorer.of(key, shared.value)
            sizes = np.array([scorer.sizes(t) for t in batch.column(1).to_pylist()]).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(sizes[:, i]) for i in range(4))], ["label", *"abcd"])

    return rows.select("label", "text").mapInArrow(run, "label int, a double, b double, c double, d double")


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` of every row: how likely label 1 is, from the whole text alone.

    Null counts as empty; empty texts are scored too, by their sizes of next to nothing. A text beyond the sizes and lengths of
    those it was calibrated on, as a very long one may be, is compressed whole and counts as the nearest of them. Repeated rows score
    alike, null doc_ids stay null, an empty table gives an empty result. One pass, no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = uuid.uuid4().hex

    def each(ids: list, texts: list) -> dict:
        return {"doc_id": ids, "score": Scorer.of(key, shared.value).scores(texts)}

    return map_texts(docs, each, "doc_id long, score double", id_col, text_col)


def keep_good(docs: DataFrame, model: QualityModel, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows whose text scores at least ``least``, all columns kept, in the pass that reads them.

    Null and empty texts are scored as ``score`` does, by the empty text; repeated rows stay or go together, also null ids; an empty
    table gives an empty result. The text column may differ in case.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = uuid.uuid4().hex

    @F.pandas_udf(DoubleType())
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(Scorer.of(key, shared.value).scores(texts.tolist()), dtype="float64")

    columns = docs.columns
    at = place_of(columns, text_col)
    plain = docs.toDF(*(f"c{i}" for i in range(len(columns))))
    return plain.filter(scored(F.col(f"c{at}").cast("string")) >= least).toDF(*columns)
