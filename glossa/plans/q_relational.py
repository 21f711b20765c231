"""Queries for projections, filters, joins, unions and simple aggregates:
P1-P8, P10-P12, J1-J5, U1, A1-A9, A13."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossa.functions import text as T
from glossa.operators import ensemble as E
from glossa.operators import metrics as M
from glossa.functions import rand
from glossa.plans import fixtures as X
from glossa.plans import sqlkit as Q
from glossa.plans.registry import query, r6
from glossa.sources.tables import load

# ----------------------------------------------------------------------------- P1-P8, P10-P12

@query("p01_select_project", "SELECT CAST(doc_id AS VARCHAR) AS id, lang, text AS comment_text FROM documents")
def p01_select_project(spark, sf):
    d = load(spark, sf, "documents")
    return d.select(F.col("doc_id").cast("string").alias("id"), "lang", F.col("text").alias("comment_text"))


@query("p02_rename", "SELECT CAST(doc_id AS VARCHAR) AS id, lang, text AS content FROM documents")
def p02_rename(spark, sf):
    d = load(spark, sf, "documents")
    d = d.select("doc_id", "lang", "text").toDF("id", "lang", "content")
    return d.withColumn("id", F.col("id").cast("string"))


@query("p03_drop_column", "SELECT doc_id, quality FROM labels")
def p03_drop_column(spark, sf):
    return load(spark, sf, "labels").drop("toxic")


@query("p04_literal_column", "SELECT CAST(doc_id AS VARCHAR) AS id, 'en' AS lang, text AS comment_text "
       "FROM documents WHERE lang = 'en'")
def p04_literal_column(spark, sf):
    d = load(spark, sf, "documents").where(F.col("lang") == "en")
    return d.select(F.col("doc_id").cast("string").alias("id"), F.lit("en").alias("lang"),
                    F.col("text").alias("comment_text"))


@query("p05_cast_id", "SELECT CAST(doc_id AS VARCHAR) AS id, CAST(toxic AS VARCHAR) AS toxic_str FROM labels")
def p05_cast_id(spark, sf):
    lab = load(spark, sf, "labels")
    return lab.select(F.col("doc_id").cast("string").alias("id"), F.col("toxic").cast("string").alias("toxic_str"))


@query("p06_null_filter", X.with_fixtures("SELECT id, lang, toxic FROM comments WHERE toxic IS NOT NULL", "comments"))
def p06_null_filter(spark, sf):
    return X.comments(spark, sf).where(F.col("toxic").isNotNull()).select("id", "lang", "toxic")


@query("p07_drop_any_null", X.with_fixtures(
    "SELECT id, toxic, severe_toxicity, obscene FROM raw_labels "
    "WHERE toxic IS NOT NULL AND severe_toxicity IS NOT NULL AND obscene IS NOT NULL", "raw_labels"))
def p07_drop_any_null(spark, sf):
    return X.raw_labels(spark, sf).select("id", "toxic", "severe_toxicity", "obscene").na.drop("any")


@query("p08_equality_filter", X.with_fixtures(
    "SELECT id, comment_text FROM pool WHERE lang = 'fr' AND CAST(round_even(toxic, 0) AS INT) = 1", "pool"))
def p08_equality_filter(spark, sf):
    p = X.pool(spark, sf)
    return p.where((F.col("lang") == "fr") & (F.bround("toxic", 0).cast("int") == 1)).select("id", "comment_text")


@query("p10_in_list", X.with_fixtures(
    "SELECT s.id, s.lang, c.cluster FROM scores s JOIN clusters c ON s.id = c.id "
    "WHERE s.model = 'm0' AND s.lang IN ('es', 'tr') AND c.cluster IN (39, 52, 100, 14, 111, 80, 42, 196)",
    "scores", "clusters"))
def p10_in_list(spark, sf):
    s = X.scores(spark, sf).where((F.col("model") == "m0") & F.col("lang").isin(*E.IP_RULE_LANGS))
    c = X.clusters(spark, sf).where(F.col("cluster").isin(*E.TEMPLATE_CLUSTERS))
    return s.join(c, "id").select("id", "lang", "cluster")


@query("p11_open_interval", X.with_fixtures(
    "SELECT id, model, round(toxic, 6) AS toxic FROM scores WHERE toxic > 0.5 AND toxic < 0.9", "scores"))
def p11_open_interval(spark, sf):
    s = X.scores(spark, sf)
    return s.where((F.col("toxic") > 0.5) & (F.col("toxic") < 0.9)).select("id", "model", r6("toxic").alias("toxic"))


@query("p12_conditional_column", X.with_fixtures(
    "SELECT id, round(CASE WHEN lang = 'es' AND toxic > 0.5 AND toxic < 0.9 THEN 1.1 * toxic "
    "WHEN lang = 'fr' THEN 0.5 * toxic ELSE toxic END, 6) AS toxic_pp FROM scores WHERE model = 'm1'", "scores"))
def p12_conditional_column(spark, sf):
    s = X.scores(spark, sf).where(F.col("model") == "m1")
    t = F.col("toxic")
    v = (F.when((F.col("lang") == "es") & (t > 0.5) & (t < 0.9), F.lit(1.1) * t)
         .when(F.col("lang") == "fr", F.lit(0.5) * t).otherwise(t))
    return s.select("id", r6(v).alias("toxic_pp"))


# ----------------------------------------------------------------------------- joins

@query("j01_inner_join", X.with_fixtures(
    "SELECT s.id, round(s.toxic, 6) AS toxic, c.cluster FROM scores s JOIN clusters c ON s.id = c.id WHERE s.model = 'm2'",
    "scores", "clusters"))
def j01_inner_join(spark, sf):
    s = X.scores(spark, sf).where(F.col("model") == "m2")
    return s.join(X.clusters(spark, sf), "id", "inner").select("id", r6("toxic").alias("toxic"), "cluster")


@query("j02_left_join_drop_unmatched",
       "SELECT CAST(d.doc_id AS VARCHAR) AS id, d.lang, l.toxic FROM documents d LEFT JOIN labels l "
       "ON d.doc_id = l.doc_id WHERE l.toxic IS NOT NULL")
def j02_left_join_drop_unmatched(spark, sf):
    d = load(spark, sf, "documents").select("doc_id", "lang")
    lab = load(spark, sf, "labels").select("doc_id", "toxic")
    j = d.join(lab, "doc_id", "left").where(F.col("toxic").isNotNull())
    return j.select(F.col("doc_id").cast("string").alias("id"), "lang", "toxic")


_J3_MODELS = [m for _, (_, ms) in X.LANG_ROUTES.items() for m, _ in ms]


@query("j03_left_enrichment", X.with_fixtures(
    "SELECT b.id, b.lang, round(b.toxic, 6) AS toxic, "
    + ", ".join(f"round(ls.{m}, 6) AS {m}" for m in _J3_MODELS)
    + " FROM (SELECT id, lang, toxic FROM scores WHERE model = 'm0') b LEFT JOIN (SELECT id, "
    + ", ".join(f"max(CASE WHEN model = '{m}' THEN toxic END) AS {m}" for m in _J3_MODELS)
    + " FROM lang_scores GROUP BY id) ls ON b.id = ls.id", "scores", "lang_scores"))
def j03_left_enrichment(spark, sf):
    base = X.scores(spark, sf).where(F.col("model") == "m0").select("id", "lang", "toxic")
    d = E.wide_left(base, X.lang_scores(spark, sf), "id", "model", "toxic", _J3_MODELS)
    return d.select("id", "lang", *[r6(c).alias(c) for c in ["toxic", *_J3_MODELS]])


_J4_NAMES = ["english"] + [f"foreign_{f}" for f in range(4)] + [f"extra_{f}" for f in range(4)]


@query("j04_nway_inner_join", X.with_fixtures(
    "SELECT id, " + ", ".join(f"round(max(CASE WHEN k = '{n}' THEN toxic END), 6) AS {n}" for n in _J4_NAMES)
    + " FROM (SELECT id, CASE WHEN fold >= 0 THEN view || '_' || CAST(fold AS VARCHAR) ELSE view END AS k, toxic "
    "FROM fold_scores WHERE family = 'roberta') GROUP BY id HAVING "
    + " AND ".join(f"max(CASE WHEN k = '{n}' THEN 1 END) IS NOT NULL" for n in _J4_NAMES), "fold_scores"))
def j04_nway_inner_join(spark, sf):
    fs = X.fold_scores(spark, sf).where(F.col("family") == "roberta")
    fs = fs.select("id", F.concat_ws("_", "view", F.when(F.col("fold") >= 0, F.col("fold").cast("string"))).alias("k"),
                   "toxic")
    w = E.wide_inner(fs, "id", "k", "toxic", _J4_NAMES)
    return w.select("id", *[r6(n).alias(n) for n in _J4_NAMES])


@query("j05_weight_from_original", X.with_fixtures(
    "SELECT id, lang, round(score, 6) AS toxic, CASE WHEN original = 1 THEN 1.0 ELSE 0.0 END AS weight_no_tta, "
    "CASE WHEN original = 1 THEN 5.0 ELSE 1.0 END AS weight_tta FROM views", "views"))
def j05_weight_from_original(spark, sf):
    v = X.views(spark, sf)
    return v.select("id", "lang", r6("score").alias("toxic"),
                    F.when(F.col("original") == 1, 1.0).otherwise(0.0).alias("weight_no_tta"),
                    F.when(F.col("original") == 1, 5.0).otherwise(1.0).alias("weight_tta"))


# ----------------------------------------------------------------------------- union

@query("u01_union_all", X.with_fixtures(
    "SELECT id, lang, comment_text, CAST(toxic AS DOUBLE) AS toxic_float, NULL AS source FROM comments "
    "WHERE toxic IS NOT NULL UNION ALL SELECT CAST(id AS VARCHAR) AS id, lang, comment_text, toxic AS toxic_float, "
    "'subtitle' AS source FROM pool", "comments", "pool"))
def u01_union_all(spark, sf):
    a = (X.comments(spark, sf).where(F.col("toxic").isNotNull())
         .select("id", "lang", "comment_text", F.col("toxic").cast("double").alias("toxic_float")))
    b = X.pool(spark, sf).select(F.col("id").cast("string").alias("id"), "lang", "comment_text",
                                 F.col("toxic").alias("toxic_float"), F.lit("subtitle").alias("source"))
    return a.unionByName(b, allowMissingColumns=True)


# ----------------------------------------------------------------------------- roll-ups

def _a01_sql():
    from glossa.plans.q_tokens import _SPLIT, _sql
    return _sql(f"SELECT id, round(max({Q.u(11, 'id', 'win')}), 6) AS toxic FROM wins GROUP BY id", _SPLIT)


@query("a01_window_max", _a01_sql())
def a01_window_max(spark, sf):
    from glossa.plans.q_tokens import split_windows
    w = split_windows(spark, sf).select("id", rand.uniform(11, F.col("id"), F.col("win")).alias("toxic"))
    return E.doc_max(w).select("id", r6("toxic").alias("toxic"))


@query("a02_translation_mean", X.with_fixtures(
    "SELECT id, round(avg(score), 6) AS toxic FROM views GROUP BY id", "views"))
def a02_translation_mean(spark, sf):
    return E.doc_mean(X.views(spark, sf), score_col="score").select("id", r6("toxic").alias("toxic"))


@query("a03_checkpoint_mean", X.with_fixtures(
    "SELECT id, round(avg(toxic), 6) AS toxic FROM scores GROUP BY id", "scores"))
def a03_checkpoint_mean(spark, sf):
    s = X.scores(spark, sf)
    files = [s.where(F.col("model") == m).select("id", "toxic") for m, _, _ in X.SCORE_MODELS]
    u = files[0]
    for f in files[1:]:
        u = u.unionByName(f)
    return E.doc_mean(u).select("id", r6("toxic").alias("toxic"))


@query("a04_weighted_mean", X.with_fixtures(
    "SELECT id, round(sum(score * CASE WHEN original = 1 THEN 5.0 ELSE 1.0 END) / "
    "nullif(sum(CASE WHEN original = 1 THEN 5.0 ELSE 1.0 END), 0), 6) AS toxic_tta, "
    "round(sum(score * CASE WHEN original = 1 THEN 1.0 ELSE 0.0 END) / "
    "nullif(sum(CASE WHEN original = 1 THEN 1.0 ELSE 0.0 END), 0), 6) AS toxic_no_tta FROM views GROUP BY id", "views"))
def a04_weighted_mean(spark, sf):
    v = X.views(spark, sf)
    orig = F.col("original") == 1
    w5, w0 = F.when(orig, 5.0).otherwise(1.0), F.when(orig, 1.0).otherwise(0.0)
    g = v.groupBy("id").agg(F.sum(F.col("score") * w5).alias("a"), F.sum(w5).alias("b"),
                            F.sum(F.col("score") * w0).alias("c"), F.sum(w0).alias("d"))
    return g.select("id", r6(F.col("a") / F.nullif("b", F.lit(0.0))).alias("toxic_tta"),
                    r6(F.col("c") / F.nullif("d", F.lit(0.0))).alias("toxic_no_tta"))


@query("a05_mean_calibration", X.with_fixtures(
    "SELECT s.id, s.model, round(s.toxic / m.mu * 0.21, 6) AS toxic FROM scores s "
    "JOIN (SELECT model, avg(toxic) AS mu FROM scores GROUP BY model) m ON s.model = m.model", "scores"))
def a05_mean_calibration(spark, sf):
    c = E.calibrate(X.scores(spark, sf), "toxic", by=["model"])
    return c.select("id", "model", r6("toxic").alias("toxic"))


@query("a06_value_counts", X.with_fixtures(
    "SELECT lang, CAST(count(*) AS BIGINT) AS n, round(count(*) / CAST((SELECT count(lang) FROM comments) AS DOUBLE), 6) AS share "
    "FROM comments WHERE lang IS NOT NULL GROUP BY lang", "comments"))
def a06_value_counts(spark, sf):
    return M.value_counts(X.comments(spark, sf), "lang").select("lang", "n", r6("share").alias("share"))


@query("a07_grouped_value_counts", X.with_fixtures(
    f"SELECT lang, {Q.is_template_message('comment_text')} AS is_bot_msg, CAST(count(*) AS BIGINT) AS n "
    "FROM comments GROUP BY 1, 2", "comments"))
def a07_grouped_value_counts(spark, sf):
    c = X.comments(spark, sf).select("lang", T.is_template_message("comment_text").alias("is_bot_msg"))
    return c.groupBy("lang", "is_bot_msg").agg(F.count(F.lit(1)).alias("n"))


@query("a08_distinct_count_check", X.with_fixtures(
    "SELECT CAST(count(DISTINCT toxic) AS BIGINT) AS n_classes FROM comments", "comments"))
def a08_distinct_count_check(spark, sf):
    return M.assert_n_distinct(X.comments(spark, sf), "toxic", 2)


@query("a13_weighted_running_mean", X.with_fixtures(
    "SELECT model, round(sum(toxic * CAST(w AS DOUBLE)) / sum(CAST(w AS DOUBLE)), 6) AS avg_loss FROM "
    "(SELECT model, toxic, CAST(1 + length(id) AS BIGINT) AS w FROM scores) GROUP BY model", "scores"))
def a13_weighted_running_mean(spark, sf):
    s = X.scores(spark, sf).withColumn("w", (F.lit(1) + F.length("id")).cast("bigint"))
    return E.weighted_mean(s, ["model"], F.col("toxic"), F.col("w").cast("double"), out="avg_loss") \
        .select("model", r6("avg_loss").alias("avg_loss"))
