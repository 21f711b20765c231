"""Operator 5, quality rules: a threshold table compiled into one Spark projection.

Every statistic is an expression over the whole text (built-in functions only: no
user function, no shuffle), and every rule is a row of ``RULES``. Two base rules
(``n_words < 50``; more than half of the words in repeated 3-word windows) give
``base_failed``.

Defined results: a null or empty text has no words and fails the base rules; ratios with an
empty denominator are 0; null ids are kept as they are; equal rows get equal results; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.llm.texts import WORD_SPLIT

# --- fixed values ---------------------------------------------------------------
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
STOP_WORDS = (
    "the of and to in a is that for it with as was on be at by this are from or an not have",   # en
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an",  # de
    "le la les de des et en un une du que est pour qui dans par sur au ne pas ou il",             # fr
    "el la de que y en un una los las del se por con no para es al lo como o su",                 # es
)
# --------------------------------------------------------------------------------
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: statistic, least, most (None: open)
RULES: tuple[tuple[str, float | None, float | None], ...] = (
    ("mean_word_chars", 2.0, 14.0),
    ("symbols_per_word", None, 0.1),
    ("stop_word_share", 0.02, None),
    ("dup_line_share", None, 0.5),
    ("words_per_line", 1.5, None),
)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """``id``, the statistics, ``base_failed``, ``failed_rules`` (names, in table order) and ``kept``."""
    return compile_rules(statistics(docs, id_col, text_col), rules)


def _count(array: Column) -> Column:
    return F.size(array).cast("long")


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _repeat_words(words: str) -> Column:
    """Words covered by 3-word windows that occur twice or more, from the hashed words in
    column ``_tri`` sorted by (hash of the window, place)."""
    same = F.filter("_tri", lambda x, i: (x["h"].eqNullSafe(F.get("_tri", i - 1)["h"]))
                    | (x["h"].eqNullSafe(F.get("_tri", i + 1)["h"])))
    places = F.transform(same, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2))
    return _count(F.array_distinct(F.flatten(places)))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    stops = sorted({w for line in STOP_WORDS for w in line.split()})
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = docs.select(F.col(id_col).alias("_id"), text.alias("_t"))
    d = d.select(
        "_id",
        F.filter(F.split("_t", WORD_SPLIT), lambda w: w != "").alias("_w"),
        F.filter(F.split("_t", "\n"), lambda x: F.translate(x, BLANKS, "") != "").alias("_l"),
        F.char_length(F.translate("_t", BLANKS, "")).cast("long").alias("word_chars"),
        (F.char_length("_t") - F.char_length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    d = d.select(
        "_id", "word_chars", "n_symbols",
        _count(F.col("_w")).alias("n_words"),
        _count(F.col("_l")).alias("n_lines"),
        (_count(F.col("_l")) - _count(F.array_distinct("_l"))).alias("n_dup_lines"),
        _count(F.filter("_w", lambda w: w.isin(*stops))).alias("n_stop_words"),
        F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"),
    )
    window = F.transform("_h", lambda x, i: F.struct(
        F.xxhash64(x, F.get("_h", i + 1), F.get("_h", i + 2)).alias("h"), i.alias("p")))
    d = d.withColumn("_tri", F.array_sort(F.filter(window, lambda x: x["p"] < F.col("n_words") - 2))).drop("_h")
    return d.select(
        F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        _repeat_words("_tri").alias("n_repeat_words"), "n_lines", "n_stop_words",
        _share(F.col("word_chars"), F.col("n_words")).alias("mean_word_chars"),
        _share(F.col("n_symbols"), F.col("n_words")).alias("symbols_per_word"),
        _share(F.col("n_stop_words"), F.col("n_words")).alias("stop_word_share"),
        _share(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_line_share"),
        _share(F.col("n_words"), F.col("n_lines")).alias("words_per_line"),
    )


def compile_rules(stats: DataFrame, rules=RULES) -> DataFrame:
    """The threshold table as one projection over ``stats``."""
    def breaks(name, least, most):
        bad = F.lit(False)
        if least is not None:
            bad = bad | (F.col(name) < least)
        if most is not None:
            bad = bad | (F.col(name) > most)
        return F.when(bad, F.lit(name))

    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    failed = F.array_compact(F.array(*[breaks(*r) for r in rules]))
    return (stats.withColumn("base_failed", base).withColumn("failed_rules", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)))


def digest(result: DataFrame) -> DataFrame:
    """The columns of the query."""
    return result.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


def _sql() -> str:
    stops = ", ".join(f"'{w}'" for w in sorted({w for line in STOP_WORDS for w in line.split()}))
    blanks = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
    rules = []
    for name, least, most in RULES:
        rules += [f"{name} >= {least}"] if least is not None else []
        rules += [f"{name} <= {most}"] if most is not None else []
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS txt FROM documents),
w AS (SELECT doc_id, txt,
        list_filter(string_split_regex(txt, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
        list_filter(string_split(txt, chr(10)), lambda x: translate(x, {blanks}, '') <> '') AS ls FROM t),
s AS (SELECT doc_id, ws, len(ws) AS n_words, len(ls) AS n_lines,
        length(translate(txt, {blanks}, '')) AS word_chars,
        length(txt) - length(translate(txt, '{SYMBOLS}', '')) AS n_symbols,
        len(ls) - len(list_distinct(ls)) AS n_dup_lines,
        len(list_filter(ws, lambda x: x IN ({stops}))) AS n_stop_words FROM w),
g AS (SELECT doc_id, p, ws[p] || ' ' || ws[p + 1] || ' ' || ws[p + 2] AS tri
      FROM (SELECT doc_id, ws, unnest(range(1, n_words - 1)) AS p FROM s)),
r AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, tri) AS c FROM g),
x AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM r WHERE c > 1) GROUP BY doc_id),
a AS (SELECT s.doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(x.n, 0) AS n_repeat_words,
        CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars,
        CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbols_per_word,
        CASE WHEN n_words > 0 THEN n_stop_words / n_words ELSE 0 END AS stop_word_share,
        CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_share,
        CASE WHEN n_lines > 0 THEN n_words / n_lines ELSE 0 END AS words_per_line
      FROM s LEFT JOIN x ON s.doc_id = x.doc_id),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM a)
SELECT doc_id, CAST(n_words AS bigint) AS n_words, CAST(word_chars AS bigint) AS word_chars,
  CAST(n_symbols AS bigint) AS n_symbols, CAST(n_dup_lines AS bigint) AS n_dup_lines,
  CAST(n_repeat_words AS bigint) AS n_repeat_words, base_failed,
  NOT base_failed AND {' AND '.join(rules)} AS kept
FROM b"""


ORACLE_SQL = _sql()
