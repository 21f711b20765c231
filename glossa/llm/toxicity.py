"""Operator 12, toxicity: noisy-channel deobfuscation, then a score of the restored text.

Method:

1. Trigrams of characters are counted over every whole text (``deobfuscate.character_counts``): the
   language model. Each disguised token is restored by a Viterbi path through its lattice.
2. Words and beginnings of words (4 and 5 letters) that mark toxic texts are learned from all
   labelled documents of four fifths of the ids (crc32 of the id modulo 5 is not 0). Near copies
   count once: one text for each smallest hash of three words in a row and label. Beginnings and words that less than
   ``SUPPORT`` of the toxic texts hold are left out, so at most (mean number of them in a toxic
   text) / ``SUPPORT`` are counted further and shipped; of these pass those with a toxic share of
   ``PURITY`` or more and a likelihood ratio of ``EVIDENCE`` or more. Both are shares and tests, not counts.
3. A logistic regression over a few statistics of the restored words that pass gives the score; it
   is fitted on at most ``FIT_ROWS`` of these texts (a hashed sample, the documented bound).
4. One pass over all documents scores the whole texts, without a shuffle.

Only labelled texts are shuffled: a bitmap of the labelled ids keeps the others out of the join.

Defined results: a null text is empty and gets the score of a text without words; a null id is
scored and held out; a label counts for every row with its id, repeated labels by their maximum,
null labels not; without both kinds of labels every score is 0; equal texts get equal scores;
other columns are ignored.
"""

from __future__ import annotations

from math import exp, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.llm import deobfuscate
from glossa.llm.bitmaps import may_match
from glossa.llm.quality_bayes import clusters, fit_logistic, likelihood_ratio
from glossa.llm.storage import stored
from glossa.llm.texts import utf8_column

FOLDS = 5                 # ids of remainder 0 are held out
FIT_ROWS = 20_000         # labelled texts the regression is fitted on, at most
SUPPORT = 0.002           # share of the toxic texts that must hold a mark
PURITY = 0.5              # shrunken toxic share among the texts that hold it
EVIDENCE = 24.0           # likelihood ratio statistic (chance of about one in a million)
BEGINNINGS = (4, 5)
_CACHE = 200_000          # tokens a task remembers


class _Remembered(dict):
    """Results by token, forgotten together when they grow many."""

    def __init__(self, compute):
        super().__init__()
        self.compute = compute

    def __missing__(self, token):
        if len(self) > _CACHE:
            self.clear()
        value = self[token] = self.compute(token)
        return value


def marks_of(word: str) -> list[str]:
    return [word, *("^" + word[:k] for k in BEGINNINGS if len(word) > k)]


class Reader:
    """Marks and statistics of texts, per task."""

    def __init__(self, model: deobfuscate.LanguageModel, weights: dict | None = None):
        self.model = model
        self.weights = weights or {}
        self.marks = _Remembered(lambda t: [m for w in deobfuscate.words_of(t, model) for m in marks_of(w)])
        self.scores = _Remembered(lambda t: max((self.weight(w) for w in deobfuscate.words_of(t, model)), default=0.0))

    def weight(self, word: str) -> float:
        return max(self.weights.get(m, 0.0) for m in marks_of(word))

    def _apart(self, text: str, own: set) -> list[str]:
        if sum(len(t) == 1 for t in own) < 2:
            return []
        return deobfuscate.spaced_words(text, self.model)

    def all_marks(self, text: str) -> set:
        own = set(text.split())
        out = set()
        for token in own:
            out.update(self.marks[token])
        for word in self._apart(text, own):
            out.update(marks_of(word))
        return out

    def statistics(self, text: str) -> list[float]:
        tokens = text.split()
        own = set(tokens)
        hits = [w for w in map(self.scores.__getitem__, own) if w]
        hits += [w for w in map(self.weight, self._apart(text, own)) if w]
        return [max(hits, default=0.0), log1p(sum(hits)), log1p(len(hits)), 10.0 * len(hits) / (10 + len(tokens)), log1p(len(tokens))]


def _lower(raw) -> str:
    return str(raw, "utf-8", "replace").lower()


def _held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def training_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``toxic, key, text``: one text for each cluster of labelled near copies and label."""
    from_labels = labels.where(~_held_out("doc_id")).groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    marks = stored(from_labels.where("toxic is not null"), "marks")
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    known = may_match(rows, "_id", marks, "_id").join(marks.hint("merge"), "_id").select("toxic", "text")    # one plan at every size
    return clusters(known)


def _mark_counts(texts: DataFrame, model, only: frozenset | None = None) -> DataFrame:
    """``mark, k``: texts that hold a mark (of ``only``), summed inside the tasks first."""
    def run(batches):
        reader, sums = Reader(model), {}

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.int64())], names=["mark", "k"])
        for batch in batches:
            for text in utf8_column(batch, "text"):
                found = reader.all_marks(_lower(text))
                for m in found if only is None else found & only:
                    sums[m] = sums.get(m, 0) + 1
                if len(sums) > 4 * _CACHE:
                    yield flush()
                    sums = {}
        yield flush()
    return texts.select("text").mapInArrow(run, "mark string, k long").groupBy("mark").agg(F.sum("k").alias("k"))


def learn_marks(texts: DataFrame, model: deobfuscate.LanguageModel) -> dict[str, float]:
    """Weights (log-odds over the base rate) of the marks of toxic texts."""
    sizes = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}    # two rows
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return {}
    often = {r["mark"]: r["k"] for r in _mark_counts(texts.where("toxic = 1"), model).where(F.col("k") >= SUPPORT * toxic).collect()}
    also = {r["mark"]: r["k"] for r in _mark_counts(texts.where("toxic = 0"), model, frozenset(often)).collect()}
    base = toxic / (toxic + clean)
    out = {}
    for mark, k in often.items():
        c = also.get(mark, 0)
        if k / (k + c + 1) >= PURITY and likelihood_ratio(k, c, base) >= EVIDENCE:
            out[mark] = log((k + base) / (c + 1 - base)) - log(base / (1 - base))
    return out


class Scorer:
    """A fitted score of texts."""

    def __init__(self, model: deobfuscate.LanguageModel, weights: dict, x: np.ndarray, y: np.ndarray):
        self.model, self.weights = model, weights
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        self.coefficients = fit_logistic((x - self.mean) / self.scale, y, ridge=0.1)

    def reader(self) -> Reader:
        return Reader(self.model, self.weights)

    def score(self, reader: Reader, text: str) -> float:
        z = (np.array(reader.statistics(text)) - self.mean) / self.scale
        return 1 / (1 + exp(-min(30.0, max(-30.0, float(self.coefficients[0] + z @ self.coefficients[1:])))))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Scorer | None:
    """Learns the language model from all texts and the rest from the labels that are not held out; None without both kinds."""
    texts = training_texts(docs, labels, id_col, text_col)
    model = deobfuscate.LanguageModel(deobfuscate.character_counts(docs, text_col))
    weights = learn_marks(texts, model)
    share = max(1, -(-texts.count() // FIT_ROWS))

    def measure(batches):
        reader = Reader(model, weights)
        for batch in batches:
            x = [reader.statistics(_lower(t)) for t in utf8_column(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("o"), batch.column("toxic"), pa.array(x, pa.list_(pa.float64()))],
                                             names=["o", "toxic", "x"])
    sample = texts.withColumn("o", F.xxhash64(F.lit("fit"), "key", "toxic")).where(F.pmod("o", F.lit(share)) == 0)
    got = (sample.select("o", "toxic", "text").mapInArrow(measure, "o long, toxic int, x array<double>")
           .orderBy("o", "toxic").limit(FIT_ROWS).collect())
    y = np.array([min(1, max(0, r["toxic"])) for r in got], float)
    if not len(y) or y.min() == y.max():
        return None
    return Scorer(model, weights, np.array([r["x"] for r in got]), y)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, held_out, score, predicted`` of every row of ``docs``."""
    scorer = train(docs, labels, id_col, text_col)

    def run(batches):
        reader = scorer.reader() if scorer else None
        for batch in batches:
            s = [scorer.score(reader, _lower(t)) if scorer else 0.0 for t in utf8_column(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("held_out"), pa.array(s, pa.float64())],
                                             names=["id", "held_out", "score"])
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), _held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    scored = rows.mapInArrow(run, f"id {kind}, held_out boolean, score double")
    return scored.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def restored_texts(docs: DataFrame, model: deobfuscate.LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, text``: every text with its disguised words restored (null stays null)."""
    def run(batches):
        for batch in batches:
            texts = [None if t is None else deobfuscate.restore(t, model) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], names=["id", "text"])
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def digest(result: DataFrame) -> DataFrame:
    """The columns of the query."""
    return result.select("doc_id", "held_out", "score", "predicted")
