"""Queries for augmentation: AU1-AU4."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossa.functions import text as T
from glossa.operators import augment as AU
from glossa.operators import labels as L
from glossa.operators import sampling as S
from glossa.plans import fixtures as X
from glossa.plans import sqlkit as Q
from glossa.plans.registry import query

SEED = AU.SEED


def rows(spark, sf):
    return (X.comments(spark, sf).where(F.col("toxic").isNotNull())
            .select("id", "lang", "toxic", "comment_text"))


def mix_pool(spark, sf):
    """Pool per language: cleaned (T11), de-duplicated per (lang, text) (U2), label rounded."""
    p = X.pool(spark, sf).where(F.col("comment_text").isNotNull())
    p = p.select("id", "lang", T.clean_text_mono("comment_text").alias("comment_text"), "toxic")
    p = S.dedupe_keep_first(p, ["lang", "comment_text"], "id")
    return p.withColumn("toxic", L.round_label("toxic"))


def uq(*parts):
    return Q.u(SEED, *parts)


_ROWS = "r0 AS (SELECT id, lang, toxic, comment_text FROM comments WHERE toxic IS NOT NULL)"
_POOL = f"""pc AS (SELECT id, lang, {Q.clean_text_mono('comment_text')} AS comment_text, toxic FROM pool WHERE comment_text IS NOT NULL),
pd AS (SELECT lang, comment_text, arg_min(id, id) AS id, CAST(round_even(arg_min(toxic, id), 0) AS INT) AS toxic
  FROM pc GROUP BY lang, comment_text),
pn AS (SELECT lang, toxic, row_number() OVER (PARTITION BY lang, toxic ORDER BY {uq('id')}, id) - 1 AS idx, comment_text FROM pd),
ps AS (SELECT lang, sum(CASE WHEN toxic = 0 THEN 1 ELSE 0 END) AS n0, sum(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS n1
  FROM pn GROUP BY lang)"""


def _chain_sql(src):
    steps = {"mentions": lambda e: Q.collapse_ws(Q.strip_mentions(e)),
             "urls": lambda e: Q.collapse_ws(Q.strip_urls(e)),
             "numbers": Q.strip_numbers,
             "hashtags": lambda e: Q.collapse_ws(Q.strip_hashtags(e)),
             "duplicate_sentences": Q.dedupe_sentences}
    out = [f"c0 AS (SELECT id, lang, toxic, comment_text AS text FROM {src})"]
    for i, st in enumerate(AU.CLEAN_STEPS, start=1):
        out.append(f"c{i} AS (SELECT id, lang, toxic, CASE WHEN {uq('id', Q.s(st))} < 0.95 THEN {steps[st]('text')} "
                   f"ELSE text END AS text FROM c{i - 1})")
    return ",\n".join(out)


def _shuffle_sql(e):
    keyed = f"list_transform({Q.sentences(e)}, lambda s, i: {{'k': {uq('id', Q.s('shuf'), '(i - 1)')}, 's': s}})"
    return f"array_to_string(list_transform(list_sort({keyed}), lambda x: x.s), ' ')"


def _mix_sql(src, extra=""):
    """AU3 over rows CTE ``src`` (id, lang, toxic, text[, extra])."""
    ex = f", {extra}" if extra else ""
    mix = f"{uq('id', Q.s('mix'))} < 0.5"
    return f"""mk AS (SELECT id, lang, toxic, text{ex} FROM {src} WHERE NOT ({mix})),
mr AS (SELECT s.*, ps.n0, ps.n1 FROM {src} s LEFT JOIN ps ON s.lang = ps.lang WHERE {mix}),
mc AS (SELECT *, CASE WHEN coalesce(n0, 0) > 0 THEN (CASE WHEN toxic = 0 THEN CAST(floor({uq('id', Q.s('n_nt'))} * 5) + 1 AS INT)
    ELSE CAST(floor({uq('id', Q.s('n_nt'))} * 3) AS INT) END) ELSE 0 END AS nnt,
  CASE WHEN coalesce(n1, 0) > 0 THEN (CASE WHEN toxic = 0 THEN 0 ELSE CAST(floor({uq('id', Q.s('n_t'))} * 3) + 1 AS INT) END)
    ELSE 0 END AS nt FROM mr),
pieces AS (
  SELECT id, lang, toxic{ex}, -1 AS cls, 0 AS j, text AS self, CAST(NULL AS BIGINT) AS idx FROM mc
  UNION ALL SELECT id, lang, toxic{ex}, 0 AS cls, j, NULL AS self, CAST(floor({uq('id', Q.s('draw'), 0, 'j')} * n0) AS BIGINT) AS idx
    FROM (SELECT *, unnest(generate_series(1, nnt)) AS j FROM mc WHERE nnt > 0)
  UNION ALL SELECT id, lang, toxic{ex}, 1 AS cls, j, NULL AS self, CAST(floor({uq('id', Q.s('draw'), 1, 'j')} * n1) AS BIGINT) AS idx
    FROM (SELECT *, unnest(generate_series(1, nt)) AS j FROM mc WHERE nt > 0)),
pj AS (SELECT p.id, p.lang, p.toxic{', p.' + extra if extra else ''}, {uq('p.id', Q.s('perm'), 'p.cls', 'p.j')} AS k,
  coalesce(pn.comment_text, p.self) AS s FROM pieces p LEFT JOIN pn ON p.lang = pn.lang AND p.cls = pn.toxic AND p.idx = pn.idx),
mixed AS (SELECT id, lang, toxic{ex}, string_agg(s, ' ' ORDER BY k, s) AS text FROM pj GROUP BY id, lang, toxic{ex}),
mx AS (SELECT id, lang, toxic{ex}, text FROM mk UNION ALL SELECT id, lang, toxic{ex}, text FROM mixed)"""


@query("au01_clean_chain", X.with_fixtures("SELECT id, lang, toxic, text FROM c5", "comments",
                                           ctes=_ROWS + ",\n" + _chain_sql("r0")))
def au01_clean_chain(spark, sf):
    return AU.clean_chain(rows(spark, sf), "comment_text", "id", SEED).select("id", "lang", "toxic", "text")


@query("au02_sentence_shuffle", X.with_fixtures(
    f"SELECT id, {_shuffle_sql('comment_text')} AS text FROM r0", "comments", ctes=_ROWS))
def au02_sentence_shuffle(spark, sf):
    return rows(spark, sf).select("id", AU.shuffle_sentences("comment_text", F.col("id"), SEED).alias("text"))


@query("au03_synthetic_mix", X.with_fixtures(
    "SELECT id, lang, toxic, text FROM mx", "comments", "pool",
    ctes=_ROWS + ",\nr1 AS (SELECT id, lang, toxic, comment_text AS text FROM r0),\n" + _POOL + ",\n" + _mix_sql("r1")))
def au03_synthetic_mix(spark, sf):
    r = rows(spark, sf).withColumnRenamed("comment_text", "text")
    return AU.synthetic_mix(r, mix_pool(spark, sf), seed=SEED).select("id", "lang", "toxic", "text")


def _router_sql():
    n = f"least(len(list_filter(string_split({Q.collapse_ws('text')}, ' '), lambda t: t <> '')) + 2, 224)"
    return (_ROWS + ",\n" + _chain_sql("r0") + ",\n" + _POOL + f""",
rt AS (SELECT *, CASE WHEN {n} > {AU.LONG_FRACTION * AU.MAX_LENGTH} THEN 'shuffle' WHEN {n} < 60 THEN 'mix' ELSE 'keep' END AS route FROM c5),
rs AS (SELECT id, lang, toxic, text, route FROM rt WHERE route = 'mix'),
""" + _mix_sql("rs", "route") + f""",
fin AS (SELECT id, lang, toxic, {_shuffle_sql('text')} AS text, route FROM rt WHERE route = 'shuffle'
  UNION ALL SELECT id, lang, toxic, text, route FROM rt WHERE route = 'keep'
  UNION ALL SELECT id, lang, toxic, text, route FROM mx)""")


@query("au04_length_router", X.with_fixtures("SELECT id, lang, toxic, route, text FROM fin", "comments", "pool",
                                             ctes=_router_sql()))
def au04_length_router(spark, sf):
    d = AU.length_router(rows(spark, sf), mix_pool(spark, sf), seed=SEED)
    return d.select("id", "lang", "toxic", "route", "text")
