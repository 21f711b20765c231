"""Queries for roll-ups and blends: A1-A5, J1, J3-J5, W1, E1-E9."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossa.operators import ensemble as E
from glossa.operators.scale import pct_rank
from glossa.plans import fixtures as X
from glossa.plans import sqlkit as Q
from glossa.plans.registry import query, r6
from glossa.session import materialize
from glossa.sources.tables import load


# ----------------------------------------------------------------------------- building blocks

_FAMILY_SPECS = {
    # family: (folds, extra-fold map, views)
    "roberta": ((0, 1, 2, 3), None, 3),
    "bert": ((0, 1, 2, 3), {0: 0, 1: 0, 2: 0, 3: 0}, 3),
    "xlm": ((0, 1, 2), None, 2),
}
_SUM_DIGITS = 9      # printed digits of a rolled-up score: equal sums in another order stay ties


def mlm_rank(spark, sf):
    """E5: mean of two score files, inner joined on id, then W1."""
    sc = X.scores(spark, sf)
    w = E.wide_inner(sc, "id", "model", "toxic", ["m0", "m1"], rename={"m0": "mlm1", "m1": "mlm2"})
    w = w.withColumn("mlm_blend", (F.col("mlm1") + F.col("mlm2")) / F.lit(2.0))
    return pct_rank(w, "mlm_blend", "mlm")


def mono_blend(spark, sf):
    """Language-routed blend of a base score with per-language models."""
    base = X.scores(spark, sf).where(F.col("model") == "m0").select("id", "lang", "toxic")
    return E.lang_routed(base, X.lang_scores(spark, sf), routes=X.LANG_ROUTES)


def families(spark, sf, incomplete=False):
    return E.power_mean_blends(X.fold_scores(spark, sf), _FAMILY_SPECS, incomplete)


def rank_blend(fams):
    """Weighted mean of the families' ranks."""
    return E.rank_columns(fams, list(_FAMILY_SPECS), suffix="").select("id", E.family_blend(None, "toxic"))


def rolled_views(spark, sf):
    """E8 over the files of the translated views, one per language."""
    return E.tta_rollups(X.views(spark, sf), file_col="lang")


def final_blend(spark, sf):
    """E7 over the chain: E1's roberta alone and as base of the routed blend (E6), the mean of E8's
    variants, and E4 as it is; each ranked over its own ids, inner joined on id."""
    fams = materialize(families(spark, sf, incomplete=True))
    roberta = fams.where("roberta is not null").select("id", F.col("roberta").alias("toxic"))
    langs = load(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), "lang")
    mono = E.lang_routed(roberta.join(langs, "id", "left"), X.lang_scores(spark, sf), routes=X.LANG_ROUTES)
    pair = rolled_views(spark, sf).dropna()
    mean = F.round((F.col("no_tta") + F.col("tta")) / F.lit(2.0), _SUM_DIGITS)
    return E.final_rank_blend({
        "single_roberta": roberta.withColumnRenamed("toxic", "value"),
        "mlm": pair.select("id", mean.alias("value")),
        "mono": mono.select("id", "lang", F.col("pred").alias("value")),
        "mas": rank_blend(fams.dropna()).withColumnRenamed("toxic", "value"),
    })


def post_processed(spark, sf):
    return E.post_process(final_blend(spark, sf), X.comments(spark, sf), X.clusters(spark, sf))


def flagship(spark, sf):
    """E9 over E7: the final submission ``id, toxic``."""
    return post_processed(spark, sf).select("id", r6(F.col("blend_pp")).alias("toxic"))


def flagship_rules(spark, sf):
    """Correlation of the blend with the running value after each rule."""
    pp = post_processed(spark, sf)
    return pp.agg(*[r6(F.corr("blend", c)).alias(f"corr_{c}") for c in ("pp_ip", "pp_bot", "blend_pp")])


# ----------------------------------------------------------------------------- SQL twins

_MLM_SQL = """mlm_in AS (
  SELECT id, max(CASE WHEN model = 'm0' THEN toxic END) AS mlm1, max(CASE WHEN model = 'm1' THEN toxic END) AS mlm2
  FROM scores GROUP BY id
  HAVING max(CASE WHEN model = 'm0' THEN 1 END) IS NOT NULL AND max(CASE WHEN model = 'm1' THEN 1 END) IS NOT NULL),
mlm_b AS (SELECT id, mlm1, mlm2, (mlm1 + mlm2) / CAST(2 AS DOUBLE) AS mlm_blend FROM mlm_in),
mlm AS (SELECT id, mlm1, mlm2, mlm_blend, """ + Q.pct_rank("mlm_blend") + """ AS mlm FROM mlm_b)"""


def _routed_case():
    parts = []
    for lang, (wb, ms) in X.LANG_ROUTES.items():
        v = f"{wb} * b.toxic" + "".join(f" + {wm} * ls.{m}" for m, wm in ms)
        parts.append(f"WHEN b.lang = '{lang}' THEN {v}")
    return "CASE " + " ".join(parts) + " ELSE b.toxic END"


_MODELS = [m for _, (_, ms) in X.LANG_ROUTES.items() for m, _ in ms]
_ROUTED_SQL = f"""ls AS (SELECT id, {', '.join(f"max(CASE WHEN model = '{m}' THEN toxic END) AS {m}" for m in _MODELS)}
  FROM lang_scores GROUP BY id),
mono_b AS (SELECT b.id, b.lang, b.toxic, {_routed_case()} AS pred FROM base b LEFT JOIN ls ON b.id = ls.id)"""
_MONO_SQL = "base AS (SELECT id, lang, toxic FROM scores WHERE model = 'm0'),\n" + _ROUTED_SQL


def _family_sql(family):
    folds, extra, views = _FAMILY_SPECS[family]
    extra = extra or {}
    names = ["english"] + [f"foreign_{f}" for f in folds]
    if views == 3:
        names += sorted({f"extra_{extra.get(f, f)}" for f in folds})
    w = (f"w_{family} AS (SELECT id, " + ", ".join(f"max(CASE WHEN k = '{n}' THEN toxic END) AS {n}" for n in names)
         + f" FROM (SELECT id, CASE WHEN fold >= 0 THEN view || '_' || CAST(fold AS VARCHAR) ELSE view END AS k, toxic "
         f"FROM fold_scores WHERE family = '{family}') GROUP BY id HAVING "
         + " AND ".join(f"max(CASE WHEN k = '{n}' THEN 1 END) IS NOT NULL" for n in names) + ")")
    roots = []
    for f in folds:
        rest = (f"(0.5 * english + 0.5 * extra_{extra.get(f, f)})" if views == 3 else "english")
        roots.append(f"sqrt(0.8 * foreign_{f} + 0.2 * {rest})")
    mean = f"(({' + '.join(roots)}) / {float(len(folds))})"
    return w + f",\nf_{family} AS (SELECT id, {mean} * {mean} AS {family} FROM w_{family})"


_FAM_SQL = ",\n".join(_family_sql(f) for f in _FAMILY_SPECS) + """,
fam AS (SELECT r.id, r.roberta, b.bert, x.xlm FROM f_roberta r JOIN f_bert b ON r.id = b.id JOIN f_xlm x ON r.id = x.id)"""
_PROB = "(" + " + ".join(f"{w} * {n}" for n, w in E.FAMILY_WEIGHTS) + f") / {sum(w for _, w in E.FAMILY_WEIGHTS)}"
_RANK_BLEND_SQL = (f"SELECT id, {_PROB} AS toxic FROM (SELECT id, "
                   + ", ".join(f"{Q.pct_rank(n)} AS {n}" for n, _ in E.FAMILY_WEIGHTS) + " FROM fam)")


def _tta_sql():
    def weight(v):
        wo, wt = E.TTA_WEIGHTS[v]
        return f"CASE WHEN original = 1 THEN {wo} ELSE {wt} END"
    sums = ", ".join(f"sum(toxic * {weight(v)}) / nullif(sum({weight(v)}), 0) AS {v}" for v in E.TTA_WEIGHTS)
    again = ", ".join(f"{v} / (SELECT avg({v}) FROM rolled) * {E.CALIBRATION_MEAN} AS {v}" for v in E.TTA_WEIGHTS)
    return (f"""cal AS (SELECT id, original, score / avg(score) OVER (PARTITION BY lang) * {E.CALIBRATION_MEAN} AS toxic FROM views),
rolled AS (SELECT id, {sums} FROM cal GROUP BY id),
tta2 AS (SELECT id, {again} FROM rolled)""")


_FINAL_SQL = _FAM_SQL + ",\n" + _tta_sql() + f""",
base AS (SELECT r.id, d.lang, r.roberta AS toxic FROM f_roberta r LEFT JOIN (SELECT cast(doc_id AS varchar) AS id, lang FROM documents) d ON r.id = d.id),
""" + _ROUTED_SQL + f""",
mlm AS (SELECT id, {Q.pct_rank("v")} AS mlm FROM
  (SELECT id, round((no_tta + tta) / CAST(2 AS DOUBLE), {_SUM_DIGITS}) AS v FROM tta2 WHERE no_tta IS NOT NULL AND tta IS NOT NULL)),
single AS (SELECT id, {Q.pct_rank("roberta")} AS single_roberta FROM f_roberta),
mono AS (SELECT id, lang, {Q.pct_rank("pred")} AS mono FROM mono_b),
mas AS (SELECT id, toxic AS mas FROM ({_RANK_BLEND_SQL})),
fin AS (SELECT s.id, o.lang, {' + '.join(f"{w} * {n}" for n, w in E.FINAL_WEIGHTS)} AS blend
  FROM single s JOIN mlm m ON s.id = m.id JOIN mono o ON s.id = o.id JOIN mas a ON s.id = a.id)"""

_LO, _HI = E.IP_RULE_BAND
_PP_SQL = _FINAL_SQL + f""",
fl AS (SELECT id, {Q.has_ipv4("comment_text")} AS has_ip, {Q.is_template_message("comment_text")} AS is_bot_msg FROM comments),
pp1 AS (SELECT f.*, fl.has_ip, fl.is_bot_msg, c.cluster,
  CASE WHEN fl.has_ip = 1 AND f.lang IN {E.IP_RULE_LANGS} AND f.blend > {_LO} AND f.blend < {_HI} THEN {E.IP_RULE_FACTOR} * f.blend ELSE f.blend END AS p1
  FROM fin f JOIN fl ON f.id = fl.id JOIN clusters c ON f.id = c.id),
pp2 AS (SELECT *, CASE WHEN is_bot_msg THEN {E.BOT_FACTOR} * p1 ELSE p1 END AS p2 FROM pp1),
pp AS (SELECT *, CASE WHEN cluster IN {E.TEMPLATE_CLUSTERS} THEN {E.CLUSTER_FACTOR} * p2 ELSE p2 END AS blend_pp FROM pp2)"""
_CHAIN = ("fold_scores", "views", "lang_scores")

FLAGSHIP_SQL = X.with_fixtures("SELECT id, round(blend_pp, 6) AS toxic FROM pp",
                               *_CHAIN, "comments", "clusters", ctes=_PP_SQL)


# ----------------------------------------------------------------------------- registered queries

@query("e09_post_process", FLAGSHIP_SQL)
def e09_post_process(spark, sf):
    return flagship(spark, sf)


@query("e07_final_rank_blend", X.with_fixtures(
    "SELECT id, lang, round(blend, 6) AS blend FROM fin", *_CHAIN, ctes=_FINAL_SQL))
def e07_final_rank_blend(spark, sf):
    return final_blend(spark, sf).select("id", "lang", r6("blend").alias("blend"))


@query("e05_mean_rank", X.with_fixtures(
    "SELECT id, round(mlm_blend, 6) AS mlm_blend, round(mlm, 6) AS mlm_blend_rank FROM mlm", "scores", ctes=_MLM_SQL))
def e05_mean_rank(spark, sf):
    m = mlm_rank(spark, sf)
    return m.select("id", r6("mlm_blend").alias("mlm_blend"), r6("mlm").alias("mlm_blend_rank"))


@query("e06_lang_routed_blend", X.with_fixtures(
    "SELECT id, lang, round(pred, 6) AS pred, round(r, 6) AS mono_rank FROM mono", "scores", "lang_scores",
    ctes=_MONO_SQL + ",\nmono AS (SELECT id, lang, pred, " + Q.pct_rank("pred") + " AS r FROM mono_b)"))
def e06_lang_routed_blend(spark, sf):
    d = pct_rank(mono_blend(spark, sf), "pred", "r")
    return d.select("id", "lang", r6("pred").alias("pred"), r6("r").alias("mono_rank"))


@query("w01_pct_rank", X.with_fixtures(
    "SELECT id, model, round(toxic, 6) AS toxic, round(" + Q.pct_rank("toxic", "model") + ", 6) AS toxic_rank FROM scores",
    "scores"))
def w01_pct_rank(spark, sf):
    d = pct_rank(X.scores(spark, sf), "toxic", "toxic_rank", part_cols=["model"])
    return d.select("id", "model", r6("toxic").alias("toxic"), r6("toxic_rank").alias("toxic_rank"))


@query("a09_corr", X.with_fixtures(
    "SELECT round(corr(blend, p1), 6) AS corr_pp_ip, round(corr(blend, p2), 6) AS corr_pp_bot, "
    "round(corr(blend, blend_pp), 6) AS corr_blend_pp FROM pp", *_CHAIN, "comments", "clusters",
    ctes=_PP_SQL))
def a09_corr(spark, sf):
    return flagship_rules(spark, sf)


# ----------------------------------------------------------------------------- fold blends (E1-E4), TTA

def family_score(spark, sf, family):
    folds, extra, views = _FAMILY_SPECS[family]
    return E.power_mean_blend(X.fold_scores(spark, sf), family, folds, extra, views, out=family)


def _fam_query(family, key):
    @query(key, X.with_fixtures(f"SELECT id, round({family}, 6) AS toxic FROM f_{family}", "fold_scores",
                                ctes=_family_sql(family)))
    def run(spark, sf):
        return family_score(spark, sf, family).select("id", r6(family).alias("toxic"))
    run.__name__ = key
    return run


_fam_query("roberta", "e01_power_mean_3view")
_fam_query("bert", "e01_power_mean_3view_shared_extra")
_fam_query("xlm", "e02_power_mean_2view")


@query("e03_prob_blend", X.with_fixtures(f"SELECT id, round({_PROB}, 6) AS toxic_prob FROM fam", "fold_scores", ctes=_FAM_SQL))
def e03_prob_blend(spark, sf):
    return families(spark, sf).select("id", r6(E.family_blend(None, "toxic_prob")).alias("toxic_prob"))


@query("e04_rank_blend", X.with_fixtures(f"SELECT id, round(toxic, 6) AS toxic FROM ({_RANK_BLEND_SQL})", "fold_scores",
                                         ctes=_FAM_SQL))
def e04_rank_blend(spark, sf):
    return rank_blend(families(spark, sf)).select("id", r6("toxic").alias("toxic"))


@query("e08_tta_rollup", X.with_fixtures(
    " UNION ALL ".join(f"SELECT id, '{v}' AS variant, round({v}, 6) AS toxic FROM tta2" for v in E.TTA_WEIGHTS), "views",
    ctes=_tta_sql()))
def e08_tta_rollup(spark, sf):
    rows = F.explode(F.array(*[F.struct(F.lit(v).alias("variant"), r6(v).alias("toxic")) for v in E.TTA_WEIGHTS]))
    return rolled_views(spark, sf).select("id", rows.alias("_r")).select("id", "_r.variant", "_r.toxic")
