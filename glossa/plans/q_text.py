"""Queries for the text functions T1-T14 over the ``comments`` fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossa.functions import text as T
from glossa.operators import sentences as SN
from glossa.plans import fixtures as X
from glossa.plans import sqlkit as Q
from glossa.plans.registry import query, r6

_CASES = {
    "t01_strip_digits_quotes": (T.strip_digits_quotes, Q.strip_digits_quotes),
    "t02_strip_hashtags": (T.strip_hashtags, Q.strip_hashtags),
    "t03_strip_mentions": (T.strip_mentions, Q.strip_mentions),
    "t04_strip_urls": (T.strip_urls, Q.strip_urls),
    "t05_collapse_ws": (T.collapse_ws, Q.collapse_ws),
    "t06_strip_numbers": (T.strip_numbers, Q.strip_numbers),
    "t07_trim": (T.py_strip, Q.py_strip),
    "t08_clean_text": (T.clean_text, Q.clean_text),
    "t10_dedupe_sentences": (T.dedupe_sentences, Q.dedupe_sentences),
    "t11_clean_text_mono": (T.clean_text_mono, Q.clean_text_mono),
}


def _register(key, sfn, qfn):
    sql = X.with_fixtures(f"SELECT id, lang, {qfn('comment_text')} AS comment_text FROM comments", "comments")

    @query(key, sql)
    def run(spark, sf):
        return X.comments(spark, sf).select("id", "lang", sfn("comment_text").alias("comment_text"))
    run.__name__ = key
    return run


for _k, (_s, _q) in _CASES.items():
    _register(_k, _s, _q)


@query("t09_sentence_split", X.with_fixtures(
    f"SELECT id, len(s) AS n_sentences, array_to_string(s, chr(10)) AS sentences "
    f"FROM (SELECT id, {Q.sentences(Q.clean_text('comment_text'))} AS s FROM comments)", "comments"))
def t09_sentence_split(spark, sf):
    s = T.sentences(T.clean_text("comment_text"))
    d = X.comments(spark, sf).select("id", s.alias("s"))
    return d.select("id", F.size("s").alias("n_sentences"), F.array_join("s", "\n").alias("sentences"))


# ----------------------------------------------------------------------------- sentence borders per language

_CLEAN = "cl AS (SELECT id, lang, " + Q.clean_text("comment_text") + " AS c FROM comments)"
_BARE = lambda e: Q.rr(Q.rr(f"lower({e})", SN.OPENING), r"\.$")      # noqa: E731
_ABBR = f"""tk AS (SELECT lang, unnest(list_filter(string_split(c, ' '), lambda t: t <> '')) AS t FROM cl),
tc AS (SELECT lang, {_BARE("t")} AS token, CAST(sum(CASE WHEN ends_with(t, '.') THEN 1 ELSE 0 END) AS BIGINT) AS n_period,
  CAST(sum(CASE WHEN ends_with(t, '.') THEN 0 ELSE 1 END) AS BIGINT) AS n_plain FROM tk GROUP BY ALL),
sh AS (SELECT lang, CAST(sum(n_period) AS DOUBLE) / CAST(sum(n_period + n_plain) AS DOUBLE) AS p FROM tc GROUP BY lang),
sc AS (SELECT tc.lang, token, n_period, n_plain, length(token) - length(replace(token, '.', '')) AS inner_p,
  2 * (n_period * ln({SN.P_ABBREVIATION}::DOUBLE) + n_plain * ln(1 - {SN.P_ABBREVIATION}::DOUBLE) - n_period * ln(p) - n_plain * ln(1 - p)) AS ratio
  FROM tc JOIN sh ON tc.lang IS NOT DISTINCT FROM sh.lang WHERE n_period > 0 AND regexp_matches(token, '\\p{{L}}') AND p > 0 AND p < 1),
abbr AS (SELECT * FROM (SELECT *, ratio * exp(-(length(token) - inner_p)) * (inner_p + 1) * pow(length(token) - inner_p, -n_plain) AS score FROM sc)
  WHERE score >= {SN.THRESHOLD})"""
_SPLIT = f"""pc AS (SELECT id, lang, string_split({Q.rr("c", SN.BORDER_WITH_BLANKS, chr(92) + "1" + T.SENTENCE_SEP + chr(92) + "2")}, chr(1)) AS ps FROM cl),
pe AS (SELECT id, lang, unnest(ps) AS piece, unnest(range(len(ps))) AS i FROM pc),
pk AS (SELECT *, CASE WHEN ends_with(piece, '.') THEN {_BARE("list_last(regexp_split_to_array(piece, '" + T.WS + "+'))")} END AS token FROM pe),
pj AS (SELECT pk.*, abbr.token IS NOT NULL AS joined FROM pk LEFT JOIN abbr ON pk.token = abbr.token AND pk.lang IS NOT DISTINCT FROM abbr.lang),
pg AS (SELECT *, sum(CASE WHEN before THEN 0 ELSE 1 END) OVER (PARTITION BY id ORDER BY i) AS g FROM
  (SELECT *, coalesce(lag(joined) OVER (PARTITION BY id ORDER BY i), false) AS before FROM pj)),
sw AS (SELECT id, g, min(i) AS first_i, string_agg(piece, '' ORDER BY i) AS w FROM pg GROUP BY id, g),
ss AS (SELECT id, g, CASE WHEN first_i = 0 THEN w ELSE {Q.rr("w", "^" + T.WS + "+")} END AS s FROM sw),
ls AS (SELECT id, CAST(count(*) AS INT) AS n_sentences, string_agg(s, chr(10) ORDER BY g) AS sentences FROM ss GROUP BY id)"""


def language_sentences(spark, sf):
    """``id, lang, c, sentences``: cleaned texts split with the abbreviations learned from all of them."""
    c = X.comments(spark, sf).select("id", "lang", T.clean_text("comment_text").alias("c"))
    return SN.split_sentences(c, "c", "lang", SN.learn_abbreviations(c, "c", "lang"), "id")


@query("t15_abbreviations", X.with_fixtures(
    "SELECT lang, token, n_period, n_plain, round(score, 6) AS score FROM abbr", "comments", ctes=_CLEAN + ",\n" + _ABBR))
def t15_abbreviations(spark, sf):
    c = X.comments(spark, sf).select("lang", T.clean_text("comment_text").alias("c"))
    return SN.learn_abbreviations(c, "c", "lang").withColumn("score", r6("score"))


@query("t16_sentences_by_language", X.with_fixtures(
    "SELECT cl.id, n_sentences, sentences FROM cl JOIN ls ON cl.id = ls.id", "comments", ctes=",\n".join([_CLEAN, _ABBR, _SPLIT])))
def t16_sentences_by_language(spark, sf):
    return language_sentences(spark, sf).select("id", F.size("sentences").alias("n_sentences"), F.array_join("sentences", "\n").alias("sentences"))


@query("t12_ipv4_flag", X.with_fixtures(
    f"SELECT id, lang, {Q.has_ipv4('comment_text')} AS has_ip FROM comments", "comments"))
def t12_ipv4_flag(spark, sf):
    return X.comments(spark, sf).select("id", "lang", T.has_ipv4("comment_text").alias("has_ip"))


@query("t13_template_flag", X.with_fixtures(
    f"SELECT id, lang, {Q.is_template_message('comment_text')} AS is_bot_msg FROM comments", "comments"))
def t13_template_flag(spark, sf):
    return X.comments(spark, sf).select("id", "lang", T.is_template_message("comment_text").alias("is_bot_msg"))


@query("t14_composite_key", X.with_fixtures(
    "SELECT id, lang || CAST(toxic AS VARCHAR) AS strata, CAST(CAST(round_even(toxic, 0) AS INT) AS VARCHAR) || lang AS label_lang "
    "FROM pool", "pool"))
def t14_composite_key(spark, sf):
    p = X.pool(spark, sf)
    return p.select("id", T.composite_key("lang", "toxic").alias("strata"),
                    T.composite_key(F.bround("toxic").cast("int"), "lang").alias("label_lang"))
