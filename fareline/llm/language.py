"""Language identification: known words first, character n-grams for the others."""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline.llm.common import Saved, map_texts, pick, slices

UNDETERMINED = "und"
# Bound of the fit: documents per language that it learns from, on average. All their words and n-grams are kept.
SAMPLE_PER_LANGUAGE = 1000
# Up to so many distinct language values their shares are broadcast to the rows.
BROADCAST_LANGUAGES = 10_000
LONGEST_GRAM = 4
SMOOTHING = 0.5
_CACHED_WORDS = 200_000
_GRAIN = 1 << 40
_TOKEN = re.compile(r"[^\W\d_]+")


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def grams(word: str, n: int) -> list[str]:
    """Character n-grams of a word between edge marks."""
    marked = f"<{word}>" if n > 1 else word
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


@dataclass(frozen=True)
class Table:
    """Log frequencies: a row of ``logs`` for each key, a column for each language."""

    keys: dict[str, int]
    logs: np.ndarray

    def get(self, key: str) -> np.ndarray | None:
        at = self.keys.get(key)
        return None if at is None else self.logs[at]


@dataclass(frozen=True)
class LanguageModel:
    """Per-language log frequencies of words, and of n-grams by length."""

    languages: tuple[str, ...]
    words: Table
    grams: tuple[Table, ...]


class Identifier:
    """Scores of one model with the evidence of each word remembered."""

    _made: dict[str, Identifier] = {}

    def __init__(self, model: LanguageModel):
        self.model = model
        self.none = np.zeros(len(model.languages))
        self.index: dict[str, int] = {}
        self.rows = np.zeros((1024, len(model.languages)))

    @classmethod
    def of(cls, key: str, model: LanguageModel) -> Identifier:
        """The one of this worker for ``key``, which no other use of a model has."""
        if key not in cls._made:
            cls._made.clear()
            cls._made[key] = cls(model)
        return cls._made[key]

    def evidence(self, word: str) -> np.ndarray:
        """Log frequencies of a known word; else the mean of its longest known n-grams, length by length."""
        known = self.model.words.get(word)
        if known is not None:
            return known
        for n in range(len(self.model.grams), 0, -1):
            table = self.model.grams[n - 1]
            at = [i for g in grams(word, n) if (i := table.keys.get(g)) is not None]
            if at:
                return table.logs[at].mean(axis=0)
        return self.none

    def _row(self, word: str) -> int:
        at = len(self.index)
        if at == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        values = self.evidence(word)
        self.rows[at] = values - values.max()
        self.index[word] = at
        return at

    def predict(self, text: str | None) -> tuple[str, float]:
        words = tokens(text)
        if not words or not any(c.isalpha() for w in words for c in w) or not self.model.languages:
            return UNDETERMINED, 0.0
        if len(self.index) > _CACHED_WORDS:
            self.index.clear()
        get = self.index.get
        at = [i if (i := get(w)) is not None else self._row(w) for w in words]
        total = self.rows[at].sum(0)
        best = int(total.argmax())
        # Words are not independent: the evidence counts as that of the square root of their number.
        scaled = (total - total[best]) / np.sqrt(len(words))
        return self.model.languages[best], float(1 / np.exp(scaled).sum())


def _sample(docs: DataFrame, per_language: int) -> DataFrame:
    """About ``per_language`` rows of each language, drawn by a hash of doc_id and text."""
    counts = docs.groupBy(F.col("lang").alias("same")).count()
    shares = Saved(docs.sparkSession, "languages")(counts.select("same", F.least(
        F.lit(1.0), per_language / F.col("count")).alias("share")), "shares")
    if shares.limit(BROADCAST_LANGUAGES + 1).count() <= BROADCAST_LANGUAGES:
        shares = F.broadcast(shares)
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(_GRAIN)) < F.col("share") * F.lit(_GRAIN)
    return docs.join(shares, F.col("lang") == F.col("same")).filter(drawn).select(docs.columns)


def fit(docs: DataFrame, usable: Column | None = None, per_language: int = SAMPLE_PER_LANGUAGE,
        id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Count words and n-grams of about ``per_language`` rows of every language, whole texts.

    ``usable`` is a condition on ``doc_id``. Counting is distributed and done once; what reaches the driver are the counts of the sample's
    distinct words and n-grams. No language, word or n-gram is left out. Equal rows are drawn or not together.
    Without usable rows the model has no language and finds every text undetermined.
    """
    rows = pick(docs, (id_col, "long", "doc_id"), (text_col, "string", "text"), (lang_col, "string", "lang"))
    known = rows.filter("lang IS NOT NULL AND text IS NOT NULL")
    if usable is not None:
        known = known.filter(usable)
    saved = Saved(docs.sparkSession, "language")
    sample = _sample(known, per_language)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            found: Counter = Counter()
            for text, lang in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                for word in tokens(text):
                    found[lang, word] += 1
            yield pa.RecordBatch.from_pydict({
                "lang": [k[0] for k in found], "word": [k[1] for k in found], "n": pa.array(found.values(), pa.int64())})

    counted = saved(sample.select("text", "lang").mapInArrow(count, "lang string, word string, n long").groupBy(
        "lang", "word").agg(F.sum("n").alias("n")), "words")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, 4096):
            found: Counter = Counter()
            for lang, word, n in zip(*(c.to_pylist() for c in piece.columns), strict=True):
                for size in range(1, LONGEST_GRAM + 1):
                    for gram in grams(word, size):
                        found[lang, gram, size] += n
            yield pa.RecordBatch.from_pydict({
                "lang": [k[0] for k in found], "gram": [k[1] for k in found],
                "size": pa.array([k[2] for k in found], pa.int32()), "n": pa.array(found.values(), pa.int64())})

    spelled = saved(counted.mapInArrow(spell, "lang string, gram string, size int, n long").groupBy(
        "lang", "gram", "size").agg(F.sum("n").alias("n")), "grams")
    languages = tuple(sorted(r.lang for r in counted.select("lang").distinct().collect()))
    return LanguageModel(languages, _table(counted.select("lang", "word", "n"), languages), tuple(
        _table(spelled.filter(F.col("size") == size).select("lang", "gram", "n"), languages)
        for size in range(1, LONGEST_GRAM + 1)))


def _table(counts: DataFrame, languages: tuple[str, ...]) -> Table:
    """Log frequencies out of ``counts`` of language, key and number."""
    columns = counts.toArrow()
    names, told, n = (columns.column(i).combine_chunks() for i in (0, 1, 2))
    distinct = told.dictionary_encode()
    keys = distinct.dictionary.to_pylist()
    table = np.full((len(keys), len(languages)), SMOOTHING)
    place = {lang: i for i, lang in enumerate(languages)}
    by_name = names.dictionary_encode()
    column = np.array([place[lang] for lang in by_name.dictionary.to_pylist()], np.int64)
    if len(keys):
        table[distinct.indices.to_numpy(), column[by_name.indices.to_numpy()]] += n.to_numpy()
    return Table({key: i for i, key in enumerate(keys)}, np.log(table / table.sum(0)) if len(keys) else table)


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)`` of every row, from its whole text alone.

    Null texts and texts without a letter are ``und`` with score 0, as is everything for a model without languages. The
    score is the model's share for the language it names. Equal scores go to the first language by name.
    Repeated rows come out alike, null doc_ids stay null, an empty table gives an empty result. One pass, no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = uuid.uuid4().hex

    def each(ids: list, texts: list) -> dict:
        model_here = Identifier.of(key, shared.value)
        told = [model_here.predict(t) for t in texts]
        return {"doc_id": ids, "lang_pred": [t[0] for t in told], "score": [t[1] for t in told]}

    return map_texts(docs, each, "doc_id long, lang_pred string, score double", id_col, text_col)
