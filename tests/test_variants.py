"""Staged training of all variants, and encoding as a projection."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from glossa.functions import tokens as K
from glossa.operators import variants as VR
from glossa.operators import vocab as V


def rows(n=400, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        y = i % 2
        words = [rng.choice(["calm", "kind", "nice"] if not y or rng.random() < 0.1 else ["awful", "vile", "rude"]) for _ in range(3)]
        words += [f"w{rng.randrange(40)}" for _ in range(rng.randrange(12))]
        out.append((f"d{i}", words if i % 37 else [], float(y) if i % 11 else None, 1.0 if i % 3 else 0.5, "en" if i % 5 else "fr"))
    return out


@pytest.fixture(scope="module")
def table(spark):
    d = spark.createDataFrame(rows(), "id string, toks array<string>, label double, w double, lang string").withColumn(
        "holdout", F.pmod(F.xxhash64("id"), F.lit(5)) == 0)
    train = {"all": F.lit(True), "fr": F.col("lang") == "fr", "none": F.lit(False)}
    return VR.feature_table(d.repartition(3), ["id", "label", "w", "holdout"], "toks", train,
                            {"all": F.lit(True), "labelled": F.col("w") == 1.0}, {k: F.lit(k != "none") for k in train})


def dense(table):
    got = table.where("label is not null and not holdout").collect()
    x = np.zeros((len(got), VR.FEATURES + 1))
    for i, r in enumerate(got):
        for t in r["x"]:
            x[i, t] += 1 / np.sqrt(len(r["x"]))
        x[i, -1] = 1
    return got, x


def test_gradients_of_all_variants_in_one_job(table):
    got, x = dense(table)
    weights = np.random.default_rng(1).normal(size=(3, VR.FEATURES + 1))
    for stage in (0, 1):
        loss, gradient = VR._evaluate(table.where("label is not null and not holdout"), weights, stage)
        for v in range(3):
            use = np.array([r["w"] * (r["train"] >> v & 1) * (r["stages"] >> stage & 1) for r in got])
            y = np.array([r["label"] for r in got])
            m = x @ weights[v]
            mass = max(use.sum(), 1e-12)
            assert loss[v] == pytest.approx((use * (np.logaddexp(0, m) - y * m)).sum() / mass, abs=1e-9)
            assert gradient[v] == pytest.approx(x.T @ (use * (1 / (1 + np.exp(-m)) - y)) / mass, abs=1e-9)


def test_a_stage_reaches_the_minimum_and_is_pulled_to_its_start(table):
    got, x = dense(table)
    start = np.zeros((3, VR.FEATURES + 1))
    w = VR.fit_stage(table.where("label is not null and not holdout"), start, 0, ridge=0.1, steps=25)
    use = np.array([r["w"] for r in got])
    y = np.array([r["label"] for r in got])
    m = x @ w[0]
    ridge = 0.1 * w[0]
    ridge[-1] = 0
    assert np.abs(x.T @ (use * (1 / (1 + np.exp(-m)) - y)) / use.sum() + ridge).max() < 1e-3      # the gradient at the minimum
    assert (w[2] == 0).all()                                                                      # a variant without rows
    near = VR.fit_stage(table.where("label is not null and not holdout"), w, 1, ridge=100.0, steps=4)
    assert np.abs(near[0, :-1] - w[0, :-1]).max() < 0.01


def test_staged_training_scores_and_auc(table):
    weights, auc = VR.train_staged(table, ["all", "fr", "none"], 2, steps=6)
    assert auc["all"] > 0.9 and auc.get("none") is None
    got = VR.scores(table, ["id", "label"], weights, ["all", "fr", "none"]).collect()
    assert len(got) == 2 * table.count() and {r["variant"] for r in got} == {"all", "fr"} and all(0 <= r["toxic"] <= 1 for r in got)
    labelled = [r for r in got if r["variant"] == "all" and r["label"] is not None]
    assert np.mean([(r["toxic"] > 0.5) == (r["label"] > 0.5) for r in labelled]) > 0.85


def test_training_without_rows(spark, table):
    weights, auc = VR.train_staged(table.where("false"), ["all"], 1, steps=2)
    assert (weights == 0).all() and auc.get("all") is None


# --- encoding ------------------------------------------------------------------------

def test_lookup_equals_the_join(spark):
    rng = random.Random(2)
    vocab_words = [f"t{i}" for i in range(300)] + ["é", "ñ x"]
    vocab = spark.createDataFrame([(w, i + 4) for i, w in enumerate(vocab_words)], "token string, token_id int")
    docs = [(str(i), [rng.choice(vocab_words + ["unknown", ""]) for _ in range(rng.choice([0, 1, 7, 300]))]) for i in range(60)] + [("n", None)]
    df = spark.createDataFrame(docs, "id string, t array<string>").repartition(4)
    for options in ({}, {"max_tokens": 5}, {"below": 8}):
        a = V.encode_ids(df, "id", "t", vocab, vocab_size=len(vocab_words), **options)
        b = V.encode_ids(df, "id", "t", vocab, **options)
        assert a.schema.simpleString() == b.schema.simpleString()
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    table = {w: i + 4 for i, w in enumerate(vocab_words)}
    got = {r["id"]: r["raw_ids"] for r in V.encode_ids(df, "id", "t", vocab, vocab_size=len(vocab_words)).collect()}
    assert got == {i: [table.get(w, 3) for w in t or []] for i, t in docs}


def test_encoding_is_a_projection(spark):
    vocab = V.build_vocab(spark.createDataFrame([(["x", "y", "x"],)], "t array<string>"), "t", 5)
    df = spark.range(100).select(F.col("id").cast("string").alias("id"), F.lit("x y z").alias("text"))
    plan = V.encode_ids(df, "id", K.word_tokens("text"), vocab, vocab_size=5)._jdf.queryExecution().sparkPlan().toString()
    main = [line for line in plan.splitlines() if not line.lstrip().startswith(":")]            # the subquery's lines begin with a colon
    assert len(main) < len(plan.splitlines())
    assert not any(op in line.split("(")[0].split("[")[0] for line in main for op in ("Generate", "Exchange", "Join", "Aggregate"))
    assert V.encode_ids(df.limit(0), "id", K.word_tokens("text"), vocab, vocab_size=5).count() == 0


def test_empty_vocabulary(spark):
    vocab = spark.createDataFrame([], "token string, token_id int")
    df = spark.createDataFrame([("a", ["x"])], "id string, t array<string>")
    assert V.encode_ids(df, "id", "t", vocab, vocab_size=10).first()["raw_ids"] == [3]
