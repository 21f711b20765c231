"""Labels (P9, P13-P15) and blend rules (E7-E9, A4, A5, J4) on hand rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from glossa.operators import ensemble as E
from glossa.operators import labels as L


def test_round1_half_even(spark):
    vals = [0.05, 0.15, 0.25, 0.35, 0.45]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(L.round1("x")).collect()]
    assert got == [float(np.round(v, 1)) for v in vals]


def test_label_max_null_semantics(spark):
    rows = [(None, None, None), (None, 0.2, 0.3), (0.1, None, None), (0.2, 0.9, None), (0.5, 0.1, 0.2)]
    df = spark.createDataFrame(rows, "toxic double, a double, b double")
    got = [r[0] for r in df.select(L.label_max("toxic", ["a", "b"])).collect()]
    assert got == [None, None, None, 0.9, 0.5]


def test_band_filter_and_binarise_edges(spark):
    df = spark.createDataFrame([(0.3,), (0.6,), (0.29,), (0.59,), (0.61,)], "x double")
    kept = L.band_filter(df, "x", 0.3, 0.6).select("x", L.binarise("x", 0.6).alias("y")).collect()
    assert sorted((r.x, r.y) for r in kept) == [(0.29, 0), (0.6, 1), (0.61, 1)]


def test_post_process_rules(spark):
    blend = spark.createDataFrame(
        [("a", "es", 0.5), ("b", "es", 0.9), ("c", "es", 0.7), ("d", "fr", 0.7), ("e", "es", 0.6)],
        "id string, lang string, blend double")
    texts = spark.createDataFrame(
        [("a", "ip 1.2.3.4"), ("b", "ip 1.2.3.4"), ("c", "ip 1.2.3.4"), ("d", "ip 1.2.3.4"),
         ("e", "Bonjour, ip 1.2.3.4 (bot de maintenance)")], "id string, comment_text string")
    clusters = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1), ("d", 1), ("e", 39)], "id string, cluster int")
    got = {r.id: r.blend_pp for r in E.post_process(blend, texts, clusters).collect()}
    assert got["a"] == 0.5 and got["b"] == 0.9          # open interval: ends unchanged
    assert got["c"] == pytest.approx(0.77) and got["d"] == 0.7
    assert got["e"] == pytest.approx(0.6 * 1.1 * 0.5 * 0.5)   # three rules on one id


def test_weighted_mean_zero_weight_is_null(spark):
    df = spark.createDataFrame([("a", 0.4, 0.0), ("a", 0.6, 0.0), ("b", 0.2, 1.0)], "id string, v double, w double")
    got = {r.id: r.toxic for r in E.weighted_mean(df, ["id"], F.col("v"), F.col("w")).collect()}
    assert got == {"a": None, "b": 0.2}


def test_calibrate_single_file(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "id string, toxic double")
    got = {r.id: r.toxic for r in E.calibrate(df, "toxic").collect()}
    assert got == pytest.approx({"a": 0.105, "b": 0.315})


def test_tta_rollup_drops_zero_weight_from_mean(spark):
    df = spark.createDataFrame([("a", 1, 0.2), ("a", 0, 0.4), ("b", 0, 0.6)],
                               "id string, original int, score double")
    got = {r.id: r.toxic for r in E.tta_rollup(df, "no_tta").collect()}
    assert got["b"] is None and got["a"] == pytest.approx(0.21)


def test_wide_inner_drops_incomplete_ids(spark):
    long = spark.createDataFrame([("a", "x", 0.1), ("a", "y", 0.2), ("b", "x", 0.3)],
                                 "id string, name string, v double")
    got = E.wide_inner(long, "id", "name", "v", ["x", "y"]).collect()
    assert [(r.id, r.x, r.y) for r in got] == [("a", 0.1, 0.2)]


def test_two_rows_of_one_score_file_are_an_error(spark):
    long = spark.createDataFrame([("a", "x", 0.1), ("a", "x", 0.2), ("a", "y", 0.2)], "id string, name string, v double")
    base = spark.createDataFrame([("a",), ("b",)], "id string")
    with pytest.raises(Exception, match="several rows of x"):
        E.wide_inner(long, "id", "name", "v", ["x", "y"]).collect()
    with pytest.raises(Exception, match="several rows of x"):
        E.wide_left(base, long, "id", "name", "v", ["x"]).collect()
    got = E.wide_left(base, long, "id", "name", "v", ["y"]).orderBy("id").collect()
    assert [tuple(r) for r in got] == [("a", 0.2), ("b", None)]


def test_final_blend_ranks_three_inputs_and_takes_the_fourth_raw(spark):
    def scores(*values):
        return spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "id string, value double")
    blend = E.final_rank_blend({"single_roberta": scores(.1, .2, .3, .4), "mlm": scores(.9, .8, .7, .6),
                                "mono": scores(.5, .5, .1, .9), "mas": scores(.05, .95, .5, .5)}, carry=())
    got = [round(r.blend, 6) for r in blend.orderBy("id").collect()]
    # .08 * rank + .29 * rank + .44 * rank + .19 * raw; ranks in quarters, the tie is 2.5 / 4
    assert got == [round(x, 6) for x in (.08 * .25 + .29 * 1 + .44 * .625 + .19 * .05, .08 * .5 + .29 * .75 + .44 * .625 + .19 * .95,
                                         .08 * .75 + .29 * .5 + .44 * .25 + .19 * .5, .08 * 1 + .29 * .25 + .44 * 1 + .19 * .5)]


def test_rollup_calibrates_each_file_first(spark):
    df = spark.createDataFrame([("f", "a", 1, 0.2), ("f", "b", 1, 0.6), ("g", "a", 0, 2.0), ("g", "b", 0, 6.0)],
                               "file string, id string, original int, score double")
    got = {r.id: (r.no_tta, r.tta) for r in E.tta_rollups(df, file_col="file").collect()}
    # both files have the same shape after calibration: .105 and .315, whose mean is .21 already
    assert got["a"] == pytest.approx((0.105, 0.105)) and got["b"] == pytest.approx((0.315, 0.315))


def test_default_routes(spark):
    langs = ["tr", "it", "es", "ru", "fr", "pt"]
    base = spark.createDataFrame([(x, x, 0.5) for x in langs], "id string, lang string, toxic double")
    models = [(x, m) for x, (_, ms) in E.LANG_ROUTES.items() for m, _ in ms]
    scores = spark.createDataFrame([(x, m, 1.0) for x, m in models], "id string, model string, toxic double")
    got = {r.id: r.pred for r in E.lang_routed(base, scores).collect()}
    assert got == pytest.approx({**{x: 0.95 for x in langs[:5]}, "pt": 0.5})


def test_families_out_of_one_aggregate(spark):
    specs = {"a": ((0,), None, 2), "b": ((0,), None, 3)}
    rows = [("1", "a", "english", -1, .25), ("1", "a", "foreign", 0, .5), ("2", "a", "english", -1, .25), ("2", "a", "foreign", 0, .5),
            ("1", "b", "english", -1, .25), ("1", "b", "foreign", 0, .5), ("1", "b", "extra", 0, .75)]
    df = spark.createDataFrame(rows, "id string, family string, view string, fold int, toxic double")
    got = [tuple(r) for r in E.power_mean_blends(df, specs).collect()]
    assert [r[0] for r in got] == ["1"] and got[0][1:] == pytest.approx((.45, .5))
    loose = {r.id: r.b for r in E.power_mean_blends(df, specs, incomplete=True).collect()}
    assert loose["2"] is None and loose["1"] == pytest.approx(.5)


def _hash_exchanges(df):
    import re
    return re.findall(r"hashpartitioning\(([^)]*)", df._jdf.queryExecution().executedPlan().toString())


def test_few_keys_are_not_shuffle_keys(spark):
    from glossa.operators import sampling as S
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([(str(i), None if i % 5 == 0 else f"m{i % 3}", i % 2, i / 10) for i in range(60)],
                                   "id string, model string, y int, toxic double")
        assert _hash_exchanges(E.calibrate(df, "toxic", by=["model"])) == []
        for d in (S.class_balance(df, "y", 1, "id", "model"), S.stratified_chunks(df, "model", 10, "id")):
            assert all("_bucket" in keys for keys in _hash_exchanges(d))
        assert S.stratified_chunks(df, "model", 10, "id").count() == 60      # null strata stay
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_external_scorer(spark):
    from glossa.operators.model import score_in_pandas
    df = spark.createDataFrame([("a", "xx"), ("b", "")], "id string, t string")
    got = score_in_pandas(df, lambda: lambda batch: batch["t"].str.len() / 10)
    assert {r.id: r.toxic for r in got.collect()} == {"a": 0.2, "b": 0.0}


def test_classifier_learns_and_reports_its_auc(spark):
    from glossa.operators import model as MD
    rows = [(f"d{i}", ["bad" if i % 2 else "good", f"w{i % 7}"], float(i % 2)) for i in range(200)]
    df = spark.createDataFrame(rows, "id string, toks array<string>, label double")
    model, auc = MD.train_classifier(df, reg_params=(0.01,))
    assert auc == 1.0
    p = {r.id: r.toxic for r in MD.predict(model, df).collect()}
    assert len(p) == 200 and p["d1"] > 0.5 > p["d0"]
    by_word = {f"w{k}": df.where(F.col("toks")[1] == f"w{k}") for k in (0, 1)}
    models = MD.train_variants(by_word, reg_params=(0.01,))
    assert set(models) == {"w0", "w1"} and {r.id: r.toxic for r in MD.predict(models["w0"][0], df).collect()}["d1"] > 0.5
    again = MD.train_classifier(df.repartition(3), reg_params=(0.01,))[1]
    assert again == auc
