"""Operator 7, quality classifier: document evidence combined with site posteriors.

Method: hierarchical empirical Bayes.

1. A document classifier gives the probability that a document is bad (low quality or
   toxic): logistic regression over a few text statistics, one of them the number of words from
   a learned word list. The list comes from grouped counts over all labelled documents;
   near copies count once, by a minimum hash of their words. The regression is fitted on at
   most ``FIT_ROWS`` labelled documents (a hashed sample; the bound of what reaches the driver).
2. Grouped aggregation over all documents sums these probabilities by host and by path. The
   rate of a host is shrunk toward the global rate, that of a path toward its host's, each
   with a prior worth ``HOST_PRIOR`` / ``PATH_PRIOR`` documents.
3. A document's log-odds are its evidence (log-odds over those of the global rate) plus the
   log-odds of its path's posterior. It is rejected above ``REJECT``.

In ``documents`` the source is the host and the language the path; any columns can be named.

Defined results: a null host or path is a group of its own; a null text is empty; a label
counts for every row with its id; without labels of both kinds every document is kept at a
score of 0; equal rows get equal results; other columns are ignored.
"""

from __future__ import annotations

from itertools import islice
from math import log
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.llm.bitmaps import may_match
from glossa.llm.segments import gram_hashes, mix
from glossa.llm.storage import join_small, stored
from glossa.llm.texts import utf8_column, word_hashes

FIT_ROWS = 20_000
LIST_SHARE = 0.002          # share of the toxic texts that must hold a listed word
LIST_PURITY = 0.8           # shrunken share of toxic texts among those that hold it
LIST_EVIDENCE = 20.0        # likelihood ratio statistic against the share of toxic texts
_HELD = 1_000_000           # words a task counts before it passes sums on
HOST_PRIOR, PATH_PRIOR = 50.0, 20.0
REJECT = 0.5
_PUNCT = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in range(256)).lower()
_KEEP_SYMBOLS = bytes(b for b in range(256) if b not in b"#*$%&|<>")
_KEEP_UPPER = bytes(b for b in range(256) if not 65 <= b <= 90)
_KEEP_LETTERS = bytes(b for b in range(256) if not (65 <= b <= 90 or 97 <= b <= 122 or b > 127))
FEATURES = ("listed", "symbols", "upper", "repeats", "letters", "length", "word_bytes")


def plain_words(text: bytes) -> list[bytes]:
    """Words in lower case (A-Z) without punctuation."""
    return text.translate(_PUNCT).split()


def features(text: bytes, listed: frozenset) -> list[float]:
    words = text.split()
    n = max(1, len(words))
    size = max(1, len(text))
    plain = plain_words(text)
    return [float(np.log1p(sum(w in listed for w in plain) if listed else 0)),
            min(1.0, len(text.translate(None, _KEEP_SYMBOLS)) / n),
            len(text.translate(None, _KEEP_UPPER)) / size,
            sum(map(eq, words, islice(words, 1, None))) / n,
            len(text.translate(None, _KEEP_LETTERS)) / size,
            float(np.log1p(len(words))) / 10, min(30.0, size / n) / 30]


def likelihood_ratio(k: int, c: int, base: float) -> float:
    """Test statistic of ``k`` marked among ``k + c`` texts against a share of ``base``; 0 below that share."""
    n = k + c
    if k <= n * base:
        return 0.0
    return 2 * (k * log(k / (n * base)) + (c * log(c / (n * (1 - base))) if c else 0.0))


def copy_key(text) -> int:
    """A key that most near copies share and other texts hardly ever: the smallest hash of three words in a row."""
    h = word_hashes(text)
    return int(mix(gram_hashes(h, min(3, len(h)))).min() >> np.uint64(1)) if len(h) else 0


def clusters(known: DataFrame) -> DataFrame:
    """One ``text`` for each cluster of near copies (``key``) and each combination of the other columns
    of ``known`` (integers), stored. Copies are merged inside the tasks first."""
    marks = [c for c in known.columns if c != "text"]

    def run(batches):
        for batch in batches:
            keys = [copy_key(t) for t in utf8_column(batch, "text")]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *(batch.column(c) for c in (*marks, "text"))],
                                             names=["key", *marks, "text"])
    schema = ", ".join(f"{c} {'string' if c == 'text' else 'int'}" for c in (*marks, "text"))
    return stored(known.select(*marks, "text").mapInArrow(run, "key long, " + schema).groupBy("key", *marks)
                  .agg(F.min("text").alias("text")), "clusters")


def _word_counts(texts: DataFrame, only: frozenset | None = None) -> DataFrame:
    """``word, k``: texts that hold a word (of ``only``), summed inside the tasks first."""
    def run(batches):
        sums: dict = {}

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.binary()), pa.array(list(sums.values()), pa.int64())], names=["word", "k"])
        for batch in batches:
            for text in utf8_column(batch, "text"):
                own = set(plain_words(bytes(text)))
                for word in own if only is None else own & only:
                    sums[word] = sums.get(word, 0) + 1
                if len(sums) > _HELD:
                    yield flush()
                    sums = {}
        yield flush()
    return texts.select("text").mapInArrow(run, "word binary, k long").groupBy("word").agg(F.sum("k").alias("k"))


def learn_words(texts: DataFrame) -> frozenset:
    """Words that mark toxic texts, from one text (``text, toxic``) for each cluster of near copies and label.

    Words that ``LIST_SHARE`` of the toxic texts hold are counted first (at most the mean number of words of a
    toxic text over that share), then the same words in the other texts."""
    sizes = {r["t"]: r["n"] for r in texts.where("toxic is not null").groupBy((F.col("toxic") == 1).alias("t")).agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(True, 0), sizes.get(False, 0)
    if not toxic or not clean:
        return frozenset()
    often = {bytes(r["word"]): r["k"] for r in _word_counts(texts.where("toxic = 1")).where(F.col("k") >= LIST_SHARE * toxic).collect()}
    also = {bytes(r["word"]): r["k"] for r in _word_counts(texts.where("toxic <> 1"), frozenset(often)).collect()}
    base = toxic / (toxic + clean)
    return frozenset(w for w, k in often.items() if k / (k + also.get(w, 0) + 1) >= LIST_PURITY
                     and likelihood_ratio(k, also.get(w, 0), base) >= LIST_EVIDENCE)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights (intercept first) of a ridge logistic regression, by Newton steps."""
    a = np.column_stack((np.ones(len(x)), x))
    w = np.zeros(a.shape[1])
    penalty = np.full(a.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty), a.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Classifier:
    """A fitted document classifier: the word list, feature scales and weights."""

    def __init__(self, listed: frozenset, x: np.ndarray, y: np.ndarray):
        self.listed = listed
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        self.weights = fit_logistic((x - self.mean) / self.scale, y)

    def log_odds(self, text: bytes) -> float:
        x = (np.array(features(text, self.listed)) - self.mean) / self.scale
        return float(np.clip(self.weights[0] + x @ self.weights[1:], -20, 20))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Classifier | None:
    """Learns from the documents that have labels (``doc_id, quality, toxic``); None without both kinds."""
    marks = labels.groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    bad = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    marks = stored(marks, "marks")
    known = (may_match(rows, "_id", marks, "_id").join(marks.hint("merge"), "_id")     # one plan at every size
             .select(F.col("toxic").cast("int").alias("toxic"), bad.cast("int").alias("bad"), "text"))
    texts = clusters(known)
    listed = learn_words(texts)

    def measure(batches):
        for batch in batches:
            x = [features(bytes(t), listed) for t in utf8_column(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("o"), batch.column("bad"), pa.array(x, pa.list_(pa.float64()))],
                                             names=["o", "bad", "x"])
    share = max(1, -(-texts.count() // FIT_ROWS))
    sample = texts.withColumn("o", F.xxhash64(F.lit("fit"), "key", "toxic", "bad")).where(F.pmod("o", F.lit(share)) == 0)
    got = (sample.select("o", "bad", "text").mapInArrow(measure, "o long, bad int, x array<double>")
           .orderBy("o", "bad").limit(FIT_ROWS).collect())
    y = np.array([r["bad"] for r in got], float)
    if not len(y) or y.min() == y.max():
        return None
    return Classifier(listed, np.array([r["x"] for r in got]), y)


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _group(column: str | None) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("")) if column else F.lit("")


def quality_scores(docs: DataFrame, model: Classifier | None, id_col: str = "doc_id", text_col: str = "text",
                   host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """``id, evidence, host_rate, path_rate, bad_probability, kept`` and a text checksum ``v``, per row of ``docs``."""
    def score(batches):
        for batch in batches:
            e = [model.log_odds(bytes(t)) if model else -20.0 for t in utf8_column(batch, "text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "v", "host", "path")), pa.array(e, pa.float64())],
                                             names=["id", "v", "host", "path", "e"])
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("v"), _group(host_col).alias("host"),
                       _group(path_col).alias("path"), text.alias("text"))
    scored = stored(rows.mapInArrow(score, f"id {kind}, v long, host string, path string, e double"), "evidence")
    p = 1 / (1 + F.exp(-F.col("e")))
    paths = stored(scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum(p).alias("b")), "paths")
    total = paths.agg(F.sum("n").alias("n"), F.sum("b").alias("b")).first()              # one row
    rate = min(0.99, max(0.001, (total["b"] or 0.0) / max(1, total["n"] or 0)))
    hosts = paths.groupBy("host").agg(((F.sum("b") + HOST_PRIOR * rate) / (F.sum("n") + HOST_PRIOR)).alias("host_rate"))
    paths = stored(paths.join(hosts, "host").withColumn(
        "path_rate", (F.col("b") + PATH_PRIOR * F.col("host_rate")) / (F.col("n") + PATH_PRIOR)).drop("n", "b"), "rates")
    odds = F.col("e") - _logit(F.lit(rate)) + _logit(F.greatest(F.lit(0.001), F.least(F.lit(0.99), F.col("path_rate"))))
    out = join_small(scored, paths, ["host", "path"]).withColumn("bad_probability", 1 / (1 + F.exp(-odds)))
    return out.select(F.col("id").alias(id_col), F.col("e").alias("evidence"), "host_rate", "path_rate", "bad_probability",
                      (F.col("bad_probability") <= REJECT).alias("kept"), "v")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             host_col: str = "source", path_col: str = "lang") -> DataFrame:
    model = train(docs, labels, id_col, text_col)
    return quality_scores(docs, model, id_col, text_col, host_col, path_col)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier keeps."""
    bad = classify(docs, labels, id_col, text_col).where(~F.col("kept")).select(F.col(id_col).alias("_id"), F.col("v").alias("_v")).distinct()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.struct(*docs.columns).alias("_r"), F.col(id_col).alias("_id0"), F.xxhash64(text).alias("_v0"))
    return rows.join(bad, F.col("_id0").eqNullSafe(F.col("_id")) & (F.col("_v0") == F.col("_v")), "left_anti").select("_r.*")


def digest(result: DataFrame) -> DataFrame:
    """The columns of the query."""
    return result.select("doc_id", F.round("evidence", 6).alias("evidence"), F.round("path_rate", 6).alias("path_rate"),
                         F.round("bad_probability", 6).alias("bad_probability"), "kept")
