"""Queries for label preparation: P9, P13-P15, E10-E12."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossa.operators import labels as L
from glossa.functions import rand
from glossa.plans import fixtures as X
from glossa.plans import sqlkit as Q
from glossa.plans.registry import query

SEED = 5353


def _round1_sql(e):
    return f"(CAST(round_even({e} * 10.0, 0) AS DOUBLE) / 10.0)"


def _label_max_sql(t, subs):
    inner = f"greatest({', '.join(subs)})" if len(subs) > 1 else subs[0]
    return f"(CASE WHEN {t} IS NOT NULL AND {inner} IS NOT NULL THEN greatest({t}, {inner}) END)"


@query("p09_band_filter", X.with_fixtures(
    "SELECT id, lang, toxic FROM pool WHERE toxic < 0.3 OR toxic >= 0.6", "pool"))
def p09_band_filter(spark, sf):
    return L.band_filter(X.pool(spark, sf), "toxic", 0.3, 0.6).select("id", "lang", "toxic")


@query("p13_binarise", X.with_fixtures(
    "SELECT id, lang, CASE WHEN toxic >= 0.6 THEN 1 ELSE 0 END AS toxic_bin, "
    "CAST(round_even(toxic, 0) AS INT) AS toxic_round FROM pool WHERE toxic < 0.3 OR toxic >= 0.6", "pool"))
def p13_binarise(spark, sf):
    d = L.band_filter(X.pool(spark, sf), "toxic", 0.3, 0.6)
    return d.select("id", "lang", L.binarise("toxic", 0.6).alias("toxic_bin"),
                    L.round_label("toxic").alias("toxic_round"))


@query("p14_label_max", X.with_fixtures(
    f"SELECT id, {_label_max_sql('toxic', ['severe_toxicity', 'obscene'])} AS toxic_float FROM raw_labels",
    "raw_labels"))
def p14_label_max(spark, sf):
    r = X.raw_labels(spark, sf)
    return r.select("id", L.label_max("toxic", ["severe_toxicity", "obscene"]).alias("toxic_float"))


@query("p15_round1", X.with_fixtures(
    f"SELECT id, {_round1_sql('toxic')} AS toxic, {_round1_sql('severe_toxicity')} AS severe_toxicity, "
    f"{_round1_sql('obscene')} AS obscene FROM raw_labels", "raw_labels"))
def p15_round1(spark, sf):
    r = X.raw_labels(spark, sf)
    return r.select("id", *[L.round1(c).alias(c) for c in ("toxic", "severe_toxicity", "obscene")])


_E12_SQL = X.with_fixtures(
    "SELECT id, 'en' AS lang, comment_text, '2018' AS source, "
    f"{_label_max_sql('toxic', ['severe_toxicity', 'obscene'])} AS toxic_float FROM raw_labels "
    "UNION ALL SELECT id, 'en' AS lang, comment_text, '2019' AS source, "
    f"{_label_max_sql(_round1_sql('toxic'), [_round1_sql('severe_toxicity'), _round1_sql('obscene')])} AS toxic_float "
    "FROM raw_labels", "raw_labels")


def training_labels(spark, sf):
    raw = X.raw_labels(spark, sf)
    a = L.training_labels(raw, ["severe_toxicity", "obscene"], round_first=False).withColumn("source", F.lit("2018"))
    b = L.training_labels(raw, ["severe_toxicity", "obscene"], round_first=True).withColumn("source", F.lit("2019"))
    return a.unionByName(b)


@query("e12_training_labels", _E12_SQL)
def e12_training_labels(spark, sf):
    return training_labels(spark, sf).select("id", "lang", "comment_text", "source", "toxic_float")


@query("e11_label_transfer", X.with_fixtures(
    "SELECT f.id, f.lang, f.comment_text, e.toxic_float FROM comments f LEFT JOIN "
    f"(SELECT id, {_label_max_sql('toxic', ['severe_toxicity', 'obscene'])} AS toxic_float FROM raw_labels) e "
    "ON f.id = e.id WHERE f.lang <> 'en' AND e.toxic_float IS NOT NULL", "comments", "raw_labels"))
def e11_label_transfer(spark, sf):
    foreign = X.comments(spark, sf).where(F.col("lang") != "en").select("id", "lang", "comment_text")
    english = L.training_labels(X.raw_labels(spark, sf), ["severe_toxicity", "obscene"], round_first=False)
    return L.transfer_labels(foreign, english).select("id", "lang", "comment_text", "toxic_float")


@query("e10_pseudo_label", X.with_fixtures(
    "SELECT c.id, c.lang, c.comment_text, " + _round1_sql("s.toxic") + " AS toxic_float, 'pseudo' AS origin, "
    + Q.u(SEED, "c.id") + " AS shuffle_key FROM comments c JOIN scores s ON c.id = s.id "
    "WHERE c.toxic IS NULL AND s.model = 'm0' "
    "UNION ALL SELECT id, lang, comment_text, CAST(toxic AS DOUBLE) AS toxic_float, 'valid' AS origin, "
    + Q.u(SEED, "id") + " AS shuffle_key FROM comments WHERE toxic IS NOT NULL", "comments", "scores"))
def e10_pseudo_label(spark, sf):
    c = X.comments(spark, sf)
    unl = c.where(F.col("toxic").isNull()).select("id", "lang", "comment_text")
    sc = X.scores(spark, sf).where(F.col("model") == "m0")
    p = L.pseudo_label(unl, sc).withColumn("origin", F.lit("pseudo"))
    v = (c.where(F.col("toxic").isNotNull())
         .select("id", "lang", "comment_text", F.col("toxic").cast("double").alias("toxic_float"))
         .withColumn("origin", F.lit("valid")))
    # the union is shuffled: the order key is a seeded uniform per id
    return p.unionByName(v).withColumn("shuffle_key", rand.uniform(SEED, F.col("id")))
