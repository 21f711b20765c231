"""AUC, checks and seeded sampling."""

import itertools

import pytest
from pyspark.sql import functions as F

from glossa.operators import metrics as M
from glossa.operators import sampling as S


def brute_auc(rows):
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    if not pos or not neg:
        return None
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg))
    return s / (len(pos) * len(neg))


@pytest.mark.parametrize("rows", [
    [(1, 0.9), (0, 0.1), (1, 0.4), (0, 0.4), (0, 0.35), (1, 0.8)],
    [(1, 0.5), (0, 0.5), (1, 0.5)],          # all tied
    [(1, 0.2), (1, 0.3)],                    # one class only
    [(int((i * 7) % 3 == 0), ((i * 13) % 10) / 10.0) for i in range(60)],
])
def test_auc_matches_pairwise(spark, rows):
    df = spark.createDataFrame(rows, "y int, p double")
    got = M.roc_auc(df, "y", "p").collect()[0]["auc"]
    want = brute_auc(rows)
    assert (got is None and want is None) or got == pytest.approx(want)


def test_auc_with_prior_rows(spark):
    rows = [(1, 0.9), (0, 0.1)]
    df = spark.createDataFrame(rows, "y int, p double")
    got = M.roc_auc(M.with_prior_rows(df, "y", "p"), "y", "p").collect()[0]["auc"]
    assert got == pytest.approx(brute_auc(rows + [(0, 0.5), (1, 0.5)]))


def test_assert_n_distinct_raises(spark):
    ok = spark.createDataFrame([(0,), (1,)], "y int")
    assert M.assert_n_distinct(ok, "y", 2).collect()[0][0] == 2
    bad = spark.createDataFrame([(1,), (1,)], "y int")
    with pytest.raises(Exception):
        M.assert_n_distinct(bad, "y", 2).collect()


def _labelled(spark, n_pos, n_neg, files=("f",)):
    rows = [(f"{f}{i}", f, 1) for f in files for i in range(n_pos)] + \
           [(f"{f}n{i}", f, 0) for f in files for i in range(n_neg)]
    return spark.createDataFrame(rows, "id string, file string, y int")


def test_class_balance_sizes(spark):
    df = _labelled(spark, 3, 20, ("a", "b"))
    got = S.class_balance(df, "y", 2, "id", file_col="file").groupBy("file", "y").count().collect()
    assert sorted((r.file, r.y, r["count"]) for r in got) == [("a", 0, 6), ("a", 1, 3), ("b", 0, 6), ("b", 1, 3)]
    few = S.class_balance(_labelled(spark, 5, 4), "y", 3, "id", file_col="file")
    assert few.where("y = 0").count() == 4          # negatives fewer than the cap


def test_equal_class_downsample_class_of_one(spark):
    rows = [(f"a{i}", "en", 0) for i in range(9)] + [("b0", "fr", 1)]
    df = spark.createDataFrame(rows, "id string, lang string, y int")
    got = S.equal_class_downsample(df, ["y", "lang"], "id").groupBy("y", "lang").count().collect()
    assert sorted(r["count"] for r in got) == [1, 1]


def test_stratified_chunks(spark):
    rows = [(f"x{i}", "en" if i % 3 else "fr", float(i % 2)) for i in range(100)]
    df = spark.createDataFrame(rows, "id string, lang string, t double").withColumn(
        "s", F.concat("lang", F.col("t").cast("string")))
    one = S.stratified_chunks(df, "s", 40, "id")           # k = 2 -> one chunk
    assert {r.chunk for r in one.collect()} == {0}
    four = S.stratified_chunks(df, "s", 25, "id").groupBy("chunk").count().collect()
    assert sorted(r["count"] for r in four) == [25, 25, 25, 25]


def test_sampling_is_partition_independent(spark):
    df = spark.range(400).select(F.col("id").cast("string").alias("id"), (F.col("id") % 5 == 0).cast("int").alias("y"))
    a = S.take_shuffled(df.repartition(1), 37, "id").collect()
    b = S.take_shuffled(df.repartition(9), 37, "id").collect()
    assert sorted(a) == sorted(b) and len(a) == 37
    h1 = S.holdout_split(df.repartition(3), "id").where("split = 'holdout'").count()
    assert h1 == 40
    f1 = sorted(S.fold_downsample(df.repartition(2).withColumn("lang", F.lit("en")), 3, "y", "id").collect())
    f2 = sorted(S.fold_downsample(df.repartition(5).withColumn("lang", F.lit("en")), 3, "y", "id").collect())
    assert f1 == f2


def test_dedupe_keep_first(spark):
    df = spark.createDataFrame([(3, "a", 0.1), (1, "a", 0.9), (2, "b", 0.5)], "id long, t string, x double")
    got = sorted((r.t, r.id, r.x) for r in S.dedupe_keep_first(df, "t", "id").collect())
    assert got == [("a", 1, 0.9), ("b", 2, 0.5)]


def test_null_groups_keep_their_rows(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "en", i % 3 % 2) for i in range(12)], "id int, lang string, y int")
    assert S.shuffle_positions(df, "id", part_cols=["lang"]).count() == 12
    assert S.stratified_chunks(df, "lang", 3, "id").count() == 12
    folds = [S.fold_downsample(df, f, "y", "id", n_folds=3).where("y = 0").count() for f in range(3)]
    assert sum(folds) == 8
    assert S.class_balance(df, "y", 1, "id", file_col="lang").where("lang is null").count() > 0
    cut = S.equal_class_downsample(df, ["lang"], "id")
    assert cut.count() == 6 and cut.where("lang is null").count() == 0


def test_take_shuffled_beyond_ten_thousand(spark):
    df = spark.range(12_000).withColumnRenamed("id", "k")
    got = S.take_shuffled(df, 11_000, "k")
    assert got.count() == got.distinct().count() == 11_000
    assert got.exceptAll(S.take_shuffled(df, 11_500, "k")).isEmpty()


def test_corpus_cap_spares_the_subset(spark):
    from glossa.plans.q_sampling import mlm_corpora
    from conftest import SF0001
    sizes = {cap: dict(mlm_corpora(spark, SF0001, cap).groupBy("corpus").count().collect()) for cap in (20, 10 ** 9)}
    assert sizes[20]["all"] == sizes[20]["valid_test"] == 20 < sizes[10 ** 9]["valid_test"]
    assert sizes[20]["subset"] == sizes[10 ** 9]["subset"] > 20


def test_chunk_offsets_need_no_window_over_all_strata(spark):
    import re
    df = spark.range(900).selectExpr("id", "concat('s', id % 300) AS s")
    d = S.stratified_chunks(df, "s", 100, "id")
    plan = d._jdf.queryExecution().optimizedPlan().toString()
    windows = [m.groups() for m in re.finditer(r"Window \[.*\], \[(.*?)\], \[(.*?)\]\n", plan + "\n")]
    assert windows and all(part.strip() or order.startswith("_bucket") for part, order in windows)
    sizes = {r.chunk: r["count"] for r in d.groupBy("chunk").count().collect()}
    assert sizes == {c: 100 for c in range(9)}
    nulls = df.selectExpr("id", "CASE WHEN id % 3 > 0 THEN id % 3 END AS s")
    assert S.stratified_chunks(nulls, "s", 100, "id").groupBy("chunk").count().count() == 9


def test_runs_read_their_chunks(spark):
    rows = [(o, c, f"{o}{c}") for o in ("subtitle", "foreign", "english") for c in range(8)]
    chunked = spark.createDataFrame(rows, "origin string, chunk int, id string")
    pseudo = spark.createDataFrame([("p",)], "id string")
    got = {}
    for r in S.route_runs(chunked, pseudo).collect():
        got.setdefault(r.run, set()).add(r.id)
    want = {f"fold{f}": {f"subtitle{f}", f"foreign{f}", "p"} for f in range(4)}
    want["base"] = {f"foreign{c}" for c in range(6)} | {"english0", "english1"}
    assert got == want
