"""Registered queries (filled in below)."""

from pyspark.sql import functions as F

from glossa.operators import metrics as M
from glossa.plans import fixtures as X
from glossa.plans.registry import query, r6


def labelled_scores(spark, sf):
    """Model scores of documents that carry a label: ``id, model, y, p``."""
    lab = X.comments(spark, sf).where(F.col("toxic").isNotNull()).select("id", F.col("toxic").alias("y"))
    return X.scores(spark, sf).select("id", "model", F.col("toxic").alias("p")).join(lab, "id", "inner")


_LS = ("ls AS (SELECT s.id, s.model, c.toxic AS y, s.toxic AS p FROM scores s "
       "JOIN comments c ON s.id = c.id WHERE c.toxic IS NOT NULL)")


def _auc_sql(src, score="p"):
    return (f"g AS (SELECT model, {score} AS score, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg "
            f"FROM {src} GROUP BY model, {score}),\n"
            "c AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model ORDER BY score "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM g)")


_AUC_SELECT = ("SELECT model, round(sum(pos * nb + 0.5 * pos * neg) / nullif(sum(pos) * sum(neg), 0), 6) AS auc "
               "FROM c GROUP BY model")


@query("a10_roc_auc", X.with_fixtures(_AUC_SELECT, "scores", "comments", ctes=_LS + ",\n" + _auc_sql("ls")))
def a10_roc_auc(spark, sf):
    return M.roc_auc(labelled_scores(spark, sf), "y", "p", ["model"]).select("model", r6("auc").alias("auc"))


@query("a11_auc_with_prior", X.with_fixtures(
    _AUC_SELECT, "scores", "comments",
    ctes=_LS + ",\nlp AS (SELECT model, y, p FROM ls UNION ALL SELECT model, v.y, v.p FROM (SELECT DISTINCT model FROM ls) "
    "m CROSS JOIN (VALUES (0, 0.5), (1, 0.5)) v(y, p)),\n" + _auc_sql("lp")))
def a11_auc_with_prior(spark, sf):
    d = M.with_prior_rows(labelled_scores(spark, sf), "y", "p", ["model"])
    return M.roc_auc(d, "y", "p", ["model"]).select("model", r6("auc").alias("auc"))


BATCH = 64          # rows an update


@query("a11_running_auc", X.with_fixtures(
    "SELECT b.model, b.batch, n_rows, round(sum(CASE WHEN x.p > n.p THEN 1.0 WHEN x.p = n.p THEN 0.5 ELSE 0.0 END * x.n * n.n) "
    "/ nullif(sum(x.n * n.n), 0), 6) AS auc FROM bs b JOIN lc x ON x.model = b.model AND x.batch <= b.batch AND x.y = 1 "
    "JOIN lc n ON n.model = b.model AND n.batch <= b.batch AND n.y = 0 GROUP BY b.model, b.batch, n_rows", "scores", "comments",
    ctes=_LS + f""",
lb AS (SELECT model, CAST(floor(CAST(id AS BIGINT) / {BATCH}) AS BIGINT) AS batch, y, p FROM ls),
bs AS (SELECT model, batch, CAST(sum(count(*)) OVER (PARTITION BY model ORDER BY batch) AS BIGINT) AS n_rows FROM lb GROUP BY model, batch),
lc AS (SELECT model, batch, y, p, count(*) AS n FROM (SELECT * FROM lb UNION ALL
  SELECT DISTINCT model, -1, v.y, v.p FROM lb CROSS JOIN (VALUES (0, 0.5), (1, 0.5)) v(y, p)) GROUP BY ALL)"""))
def a11_running_auc(spark, sf):
    d = labelled_scores(spark, sf).withColumn("batch", F.floor(F.col("id").cast("long") / F.lit(BATCH)))
    return M.running_auc(d, "y", "p", "batch", ["model"]).select("model", "batch", "n_rows", r6("auc").alias("auc"))


_BIN = "CAST(least(greatest(ceil(p * 199.0) - 1, 0), 198) AS INT)"


@query("a12_binned_auc_accuracy", X.with_fixtures(
    "SELECT a.model, round(a.auc, 6) AS auc, round(b.acc, 6) AS accuracy FROM "
    "(SELECT model, sum(pos * nb + 0.5 * pos * neg) / nullif(sum(pos) * sum(neg), 0) AS auc FROM c GROUP BY model) a "
    "JOIN (SELECT model, avg(CASE WHEN CAST(p > 0.5 AS INT) = y THEN 1.0 ELSE 0.0 END) AS acc FROM ls GROUP BY model) b "
    "ON a.model = b.model", "scores", "comments", ctes=_LS + ",\n" + _auc_sql("ls", _BIN)))
def a12_binned_auc_accuracy(spark, sf):
    d = labelled_scores(spark, sf)
    auc = M.roc_auc(d.withColumn("bin", M.threshold_bin("p")), "y", "bin", ["model"])
    acc = d.groupBy("model").agg(M.accuracy("y", "p").alias("accuracy"))
    return auc.join(acc, "model").select("model", r6("auc").alias("auc"), r6("accuracy").alias("accuracy"))


@query("a14_label_smoothed_logloss", X.with_fixtures(
    "SELECT model, round(avg(-(t * ln(q) + (1.0 - t) * ln(1.0 - q))), 6) AS logloss, "
    "round(avg(-(y * ln(q) + (1.0 - y) * ln(1.0 - q))), 6) AS logloss_plain FROM "
    "(SELECT model, CAST(y AS DOUBLE) AS y, least(greatest(p, 1e-7), 1 - 1e-7) AS q, "
    "CAST(y AS DOUBLE) * 0.9 + 0.05 AS t FROM ls) GROUP BY model", "scores", "comments", ctes=_LS))
def a14_label_smoothed_logloss(spark, sf):
    d = labelled_scores(spark, sf)
    return d.groupBy("model").agg(r6(M.log_loss("y", "p")).alias("logloss"),
                                  r6(M.log_loss("y", "p", smoothing=0.0)).alias("logloss_plain"))
