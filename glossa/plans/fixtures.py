"""Derived fixture tables, built from the driver's tables by the same rule in
Spark (DataFrame code) and in SQL (CTE text for the oracle).

Every fixture is a projection/expansion of ``documents``, ``labels`` or
``conversations``, so its size grows with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.sources.tables import load

# --- fixed values ------------------------------------------------------------
# Synthetic score models: (model, multiplier, offset); m2 misses every 50th doc.
SCORE_MODELS = (("m0", 7919, 13), ("m1", 6007, 101), ("m2", 104729, 7))
# Translated views: (lang, k).
VIEW_LANGS = (("en", 1), ("fr", 2), ("de", 3), ("es", 4))
# Per-language monolingual models: (lang, model, multiplier, offset).
LANG_MODELS = (("fr", "fr_1", 3571, 5), ("fr", "fr_2", 2203, 17),
               ("es", "es_1", 1009, 29), ("es", "es_2", 4441, 3),
               ("de", "de_1", 5333, 11))
# The routes of these models, in place of the operator's own languages.
LANG_ROUTES = {"fr": (0.1, (("fr_1", 0.45), ("fr_2", 0.45))),
               "es": (0.1, (("es_1", 0.45), ("es_2", 0.45))),
               "de": (0.1, (("de_1", 0.9),))}
# Fold predictions per family: (family, view, fold, multiplier, offset).
# 'bert' reuses extra fold 0 for every fold; 'xlm' has no extra view.
FOLD_MODELS = (
    ("roberta", "foreign", 0, 7307, 1), ("roberta", "foreign", 1, 7309, 2),
    ("roberta", "foreign", 2, 7321, 3), ("roberta", "foreign", 3, 7331, 4),
    ("roberta", "english", -1, 7333, 5),
    ("roberta", "extra", 0, 7349, 6), ("roberta", "extra", 1, 7351, 7),
    ("roberta", "extra", 2, 7369, 8), ("roberta", "extra", 3, 7393, 9),
    ("bert", "foreign", 0, 7411, 10), ("bert", "foreign", 1, 7417, 11),
    ("bert", "foreign", 2, 7433, 12), ("bert", "foreign", 3, 7451, 13),
    ("bert", "english", -1, 7457, 14), ("bert", "extra", 0, 7459, 15),
    ("xlm", "foreign", 0, 7477, 16), ("xlm", "foreign", 1, 7481, 17),
    ("xlm", "foreign", 2, 7487, 18), ("xlm", "english", -1, 7489, 19),
)
# -----------------------------------------------------------------------------


def _docs(spark, sf):
    return load(spark, sf, "documents")


def comments(spark: SparkSession, sf: str) -> DataFrame:
    """Comments with labels."""
    d = _docs(spark, sf).select("doc_id", "lang", "text")
    lab = load(spark, sf, "labels").select("doc_id", "toxic")
    ids = F.col("doc_id").cast("string")
    bot = F.col("doc_id") % 17 == 0
    text = F.concat(F.when(bot, F.lit("Bonjour, ")).otherwise(F.lit("")), F.col("text"),
                    F.when(F.col("doc_id") % 5 == 0,
                           F.concat(F.lit(" #tag"), ids, F.lit("! see http://x.example/"), ids))
                    .otherwise(F.lit("")),
                    F.when(bot, F.lit(" (bot de maintenance) ")).otherwise(F.lit("")))
    return (d.join(lab, "doc_id", "left")
            .select(ids.alias("id"), "lang", text.alias("comment_text"), "toxic"))


def raw_labels(spark: SparkSession, sf: str) -> DataFrame:
    d = _docs(spark, sf).select("doc_id", "text")
    frac = lambda m: ((F.col("doc_id") * m) % 100) / F.lit(100.0)
    return d.select(
        F.col("doc_id").cast("string").alias("id"), F.col("text").alias("comment_text"),
        F.when(F.col("doc_id") % 13 == 0, F.lit(None).cast("double")).otherwise(frac(31)).alias("toxic"),
        F.when(F.col("doc_id") % 7 == 0, F.lit(None).cast("double")).otherwise(frac(37)).alias("severe_toxicity"),
        frac(41).alias("obscene"))


def _lit_rows(rows, names):
    return F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names)]) for r in rows])


def scores(spark: SparkSession, sf: str) -> DataFrame:
    d = _docs(spark, sf).select("doc_id", "lang")
    m = d.select("doc_id", "lang", F.explode(_lit_rows(SCORE_MODELS, ("model", "a", "b"))).alias("m"))
    m = m.where(~((F.col("m.model") == "m2") & (F.col("doc_id") % 50 == 0)))
    return m.select(F.col("doc_id").cast("string").alias("id"), "lang", F.col("m.model").alias("model"),
                    (((F.col("doc_id") * F.col("m.a") + F.col("m.b")) % 997) / F.lit(997.0)).alias("toxic"))


def views(spark: SparkSession, sf: str) -> DataFrame:
    d = _docs(spark, sf).select("doc_id", F.col("lang").alias("dlang"))
    v = d.select("doc_id", "dlang", F.explode(_lit_rows(VIEW_LANGS, ("lang", "k"))).alias("v"))
    v = v.where(~((F.col("doc_id") % 40 == 0) & (F.col("v.lang") == F.col("dlang"))))
    return v.select(F.col("doc_id").cast("string").alias("id"), F.col("v.lang").alias("lang"),
                    F.when(F.col("v.lang") == F.col("dlang"), 1).otherwise(0).alias("original"),
                    (((F.col("doc_id") * 7919 + F.col("v.k") * 31) % 997) / F.lit(997.0)).alias("score"))


def pool(spark: SparkSession, sf: str) -> DataFrame:
    c = load(spark, sf, "conversations").select("conv_id", "turn", "text")
    lang = (F.when(F.col("conv_id") % 4 == 0, "en").when(F.col("conv_id") % 4 == 1, "fr")
            .when(F.col("conv_id") % 4 == 2, "de").otherwise("es"))
    return c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("text").alias("comment_text"),
                    lang.alias("lang"),
                    (((F.col("conv_id") * 7 + F.col("turn")) % 10) / F.lit(10.0)).alias("toxic"))


def clusters(spark: SparkSession, sf: str) -> DataFrame:
    d = _docs(spark, sf).select("doc_id")
    return d.where(F.col("doc_id") % 29 != 0).select(
        F.col("doc_id").cast("string").alias("id"), ((F.col("doc_id") * 61) % 200).cast("int").alias("cluster"))


def lang_scores(spark: SparkSession, sf: str) -> DataFrame:
    d = _docs(spark, sf).select("doc_id", "lang")
    arr = _lit_rows(LANG_MODELS, ("lang", "model", "a", "b"))
    m = d.select("doc_id", F.explode(F.filter(arr, lambda s: s["lang"] == F.col("lang"))).alias("m"))
    return m.select(F.col("doc_id").cast("string").alias("id"), F.col("m.model").alias("model"),
                    (((F.col("doc_id") * F.col("m.a") + F.col("m.b")) % 997) / F.lit(997.0)).alias("toxic"))


def fold_scores(spark: SparkSession, sf: str) -> DataFrame:
    d = _docs(spark, sf).select("doc_id")
    m = d.select("doc_id", F.explode(_lit_rows(FOLD_MODELS, ("family", "view", "fold", "a", "b"))).alias("m"))
    # one input file misses some ids, so the N-way inner join must drop them
    m = m.where(~((F.col("m.family") == "roberta") & (F.col("m.view") == "extra")
                  & (F.col("m.fold") == 2) & (F.col("doc_id") % 50 == 7)))
    return m.select(F.col("doc_id").cast("string").alias("id"), F.col("m.family").alias("family"),
                    F.col("m.view").alias("view"), F.col("m.fold").alias("fold"),
                    (((F.col("doc_id") * F.col("m.a") + F.col("m.b")) % 997) / F.lit(997.0)).alias("toxic"))


BUILDERS = {"comments": comments, "raw_labels": raw_labels, "scores": scores, "views": views,
            "pool": pool, "clusters": clusters, "lang_scores": lang_scores, "fold_scores": fold_scores}


# ----------------------------------------------------------------------------- SQL twins

def _values(rows):
    def one(v):
        return "'" + v + "'" if isinstance(v, str) else str(v)
    return ", ".join("(" + ", ".join(one(v) for v in r) + ")" for r in rows)


SQL = {
    "comments": """SELECT cast(d.doc_id AS varchar) AS id, d.lang AS lang,
  concat(CASE WHEN d.doc_id % 17 = 0 THEN 'Bonjour, ' ELSE '' END, d.text,
         CASE WHEN d.doc_id % 5 = 0 THEN concat(' #tag', cast(d.doc_id AS varchar), '! see http://x.example/', cast(d.doc_id AS varchar)) ELSE '' END,
         CASE WHEN d.doc_id % 17 = 0 THEN ' (bot de maintenance) ' ELSE '' END) AS comment_text,
  l.toxic AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "raw_labels": """SELECT cast(doc_id AS varchar) AS id, text AS comment_text,
  CASE WHEN doc_id % 13 = 0 THEN NULL ELSE ((doc_id * 31) % 100) / cast(100 AS double) END AS toxic,
  CASE WHEN doc_id % 7 = 0 THEN NULL ELSE ((doc_id * 37) % 100) / cast(100 AS double) END AS severe_toxicity,
  ((doc_id * 41) % 100) / cast(100 AS double) AS obscene
FROM documents""",
    "scores": f"""SELECT cast(d.doc_id AS varchar) AS id, d.lang AS lang, m.model AS model,
  ((d.doc_id * m.a + m.b) % 997) / cast(997 AS double) AS toxic
FROM documents d CROSS JOIN (VALUES {_values(SCORE_MODELS)}) m(model, a, b)
WHERE NOT (m.model = 'm2' AND d.doc_id % 50 = 0)""",
    "views": f"""SELECT cast(d.doc_id AS varchar) AS id, v.lang AS lang, CASE WHEN v.lang = d.lang THEN 1 ELSE 0 END AS original,
  ((d.doc_id * 7919 + v.k * 31) % 997) / cast(997 AS double) AS score
FROM documents d CROSS JOIN (VALUES {_values(VIEW_LANGS)}) v(lang, k)
WHERE NOT (d.doc_id % 40 = 0 AND v.lang = d.lang)""",
    "pool": """SELECT conv_id * 1000 + turn AS id, text AS comment_text,
  CASE conv_id % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'fr' WHEN 2 THEN 'de' ELSE 'es' END AS lang,
  ((conv_id * 7 + turn) % 10) / cast(10 AS double) AS toxic
FROM conversations""",
    "clusters": """SELECT cast(doc_id AS varchar) AS id, cast((doc_id * 61) % 200 AS int) AS cluster
FROM documents WHERE doc_id % 29 <> 0""",
    "lang_scores": f"""SELECT cast(d.doc_id AS varchar) AS id, m.model AS model,
  ((d.doc_id * m.a + m.b) % 997) / cast(997 AS double) AS toxic
FROM documents d JOIN (VALUES {_values(LANG_MODELS)}) m(lang, model, a, b) ON m.lang = d.lang""",
    "fold_scores": f"""SELECT cast(d.doc_id AS varchar) AS id, m.family AS family, m.view AS view, m.fold AS fold,
  ((d.doc_id * m.a + m.b) % 997) / cast(997 AS double) AS toxic
FROM documents d CROSS JOIN (VALUES {_values(FOLD_MODELS)}) m(family, view, fold, a, b)
WHERE NOT (m.family = 'roberta' AND m.view = 'extra' AND m.fold = 2 AND d.doc_id % 50 = 7)""",
}


def with_fixtures(sql: str, *names: str, ctes: str = "") -> str:
    """Prefix ``sql`` with the named fixtures (and extra ``ctes`` text) as CTEs."""
    parts = [f"{n} AS (\n{SQL[n]}\n)" for n in names]
    if ctes:
        parts.append(ctes)
    return f"WITH {',\n'.join(parts)}\n{sql}" if parts else sql
