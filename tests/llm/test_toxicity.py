"""Operator 12: restoration against brute force over all paths, held-out accuracy, edge cases."""

import itertools
import random
import zlib

import numpy as np
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from glossa.llm import deobfuscate as D
from glossa.llm import toxicity as T
from glossa.llm.bitmaps import may_match
from glossa.sources.tables import load

SYLLABLES = ["ba", "ne", "ti", "ro", "lum", "ked", "so", "vi", "gan", "pel", "dor", "mi"]
BAD = ["grolnik", "zubhart", "mepstol", "vlokker"]


def corpus(size, seed=1, toxic_share=0.3):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(size):
        words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(rng.randint(20, 80))]
        bad = rng.random() < toxic_share
        for _ in range(2 if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        docs.append((i, " ".join(words) + ".", "en"))
        labels.append((i, 1, int(bad)))
    return docs, labels


def frames(spark, docs, labels):
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumn("score", F.lit("x")).withColumn("toxic", F.lit(1)).repartition(3),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


@pytest.fixture(scope="module")
def trained(spark):
    docs, labels = corpus(600)
    return T.train(*frames(spark, docs, labels))


def best_by_enumeration(text, model):
    best = (-np.inf, "")
    for path in itertools.product(*D._options(text)):
        a = b = 0
        score = -sum(cost for _, cost in path)
        for letter, _ in path:
            if letter:
                k = D.class_of(letter)
                if not (k == 0 and b == 0):
                    score += model.rows()[a][b][k]
                    a, b = b, k
        score += model.rows()[a][b][0] if b else 0.0
        best = max(best, (score, "".join(letter for letter, _ in path)))
    return best


@pytest.mark.parametrize("token", ["gr0ln1k", "z.u.b.h.a.r.t", "meeepst0l", "vl*kker", "b4ne", "a-b", "((", "x", "1", "t i r 0"])
def test_viterbi_finds_the_best_of_all_paths(trained, token):
    got = D.decode(token, trained.model)
    score, text = best_by_enumeration(token, trained.model)
    assert got == text or score == pytest.approx(max(s for s, t in [best_by_enumeration(token, trained.model)]), abs=1e-6)
    assert got == text


def test_counts_are_of_whole_texts(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab É1.\n") for _ in range(n)) for n in (0, 1, 50, 3_000_000)] + [None]
    got = D.character_counts(spark.createDataFrame([(t,) for t in texts], "text string").repartition(2))
    want = np.zeros(D.SIZE ** 3)
    for t in texts:
        c = np.array([D.class_of(x) for x in " " + (t or "").lower() + " "], int)
        if len(c) > 2:
            want += np.bincount(c[:-2] * D.SIZE ** 2 + c[1:-1] * D.SIZE + c[2:], minlength=D.SIZE ** 3)
    got = got.ravel()
    edge = np.arange(D.SIZE ** 3) % D.SIZE ** 2 // D.SIZE == 0            # texts are joined by blanks: grams around an edge differ
    assert (got[~edge] == want[~edge]).all()


def disguise(word, rng):
    kind = rng.randrange(4)
    if kind == 0:
        return word.translate(str.maketrans({"o": "0", "i": "1", "a": "4", "e": "3", "s": "$"}))
    if kind == 1:
        return rng.choice("-._").join(word)
    if kind == 2:
        return " ".join(word)
    return "".join(c * (4 if k == 2 else 1) for k, c in enumerate(word)).capitalize() + "!!!"


def test_disguised_words_are_restored_and_scored(spark, trained):
    assert set(BAD) <= set(trained.weights)
    rng = random.Random(8)
    reader = trained.reader()
    found = 0
    for _ in range(200):
        words = corpus(1, rng.random(), 0)[0][0][1].split()
        clean = trained.score(reader, " ".join(words))
        words[3:3] = disguise(rng.choice(BAD), rng).split()
        words[9:9] = disguise(rng.choice(BAD), rng).split()
        found += trained.score(reader, " ".join(words).lower()) >= 0.5
        assert clean < 0.5
    assert found >= 185


def test_restored_texts(spark, trained):
    rows = [(1, "ba  gr0ln1k, so\n#!\tm e p s t o l"), (2, None), (3, ""), (4, "2021 ba-ne??")]
    got = dict(D_rows(T.restored_texts(spark.createDataFrame(rows, "doc_id long, text string"), trained.model)))
    assert got[1].startswith("ba  grolnik so\n#!\tmepstol"[:10]) and "grolnik" in got[1] and "mepstol" in got[1]
    assert got[2] is None and got[3] == "" and got[4].startswith("2021 ")


def D_rows(df):
    return [tuple(r) for r in df.collect()]


def test_held_out_accuracy_and_no_leak(spark):
    docs, labels = load(spark, SF001, "documents"), load(spark, SF001, "labels")
    got = T.toxicity(docs, labels).join(labels, "doc_id").collect()
    out = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    pairs = [(p["score"] > n["score"]) + 0.5 * (p["score"] == n["score"]) for p in out if p["toxic"] for n in out if not n["toxic"]]
    assert sum(pairs) / len(pairs) > 0.7 and sum(r["predicted"] > r["toxic"] for r in out) <= 0.02 * len(out)
    # labels of held-out ids change nothing
    other = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r["doc_id"]: r["score"] for r in T.toxicity(docs, other).collect()}
    assert all(again[r["doc_id"]] == pytest.approx(r["score"], abs=1e-12) for r in got)


def test_edge_cases(spark):
    docs, labels = corpus(300, 3)
    docs += [(None, docs[0][1], None), (700, None, None), (701, "", "en"), (702, "  \n#### $$$ 123", "en"), (703, BAD[0] + " " + "ba ne ti " * 200_000, "en"),
             (704, "a" * 300_000, "en")] + [docs[1]] * 3
    labels += [(None, 1, 1), (1, 0, None), (2, None, labels[2][2]), (9999, 1, 1)]
    d, m = frames(spark, docs, labels)
    got = T.digest(T.toxicity(d, m)).collect()
    assert len(got) == len(docs) and got[0].asDict().keys() == {"doc_id", "held_out", "score", "predicted"}
    by = {r["doc_id"]: r for r in got}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert by[None]["held_out"] and by[None]["score"] == by[0]["score"] and by[700]["score"] == by[701]["score"]
    assert len({r["score"] for r in got if r["doc_id"] == 1}) == 1 and sum(r["doc_id"] == 1 for r in got) == 4
    empty = T.toxicity(d.limit(0), m)
    assert empty.count() == 0 and empty.columns == ["doc_id", "held_out", "score", "predicted"]
    for none in (m.limit(0), m.withColumn("toxic", F.lit(0))):
        assert {(r["score"], r["predicted"]) for r in T.toxicity(d.where("doc_id < 20"), none).collect()} == {(0.0, 0)}


def test_copies_do_not_make_marks(spark):
    """A word of one toxic text repeated hundreds of times is no mark."""
    docs, labels = corpus(300, 6)
    docs += [(1000 + i, "unusual ba ne ti " + BAD[0], "en") for i in range(400)]
    labels += [(1000 + i, 0, 1) for i in range(400)]
    weights = T.train(*frames(spark, docs, labels)).weights
    assert "unusual" not in weights and BAD[0] in weights


def test_may_match_keeps_all_partners(spark):
    big = spark.range(20_000).withColumnRenamed("id", "k")
    some = spark.range(0, 20_000, 50).withColumnRenamed("id", "o")
    kept = {r["k"] for r in may_match(big, "k", some, "o").collect()}
    assert kept >= set(range(0, 20_000, 50)) and len(kept) < 600
    assert may_match(big, "k", some.limit(0), "o").count() == 0
