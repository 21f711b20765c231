"""Sentence borders per language (T9): abbreviations learned from the texts.

A word type is an abbreviation of its language if it is followed by a period far more often
than chance (log-likelihood ratio of a grouped count, after Kiss and Strunk 2006), is short,
has periods inside and seldom occurs without its period. A period after such a type ends no
sentence. Learning is one count of word types with map-side partial sums; splitting is a
projection that looks the types up by the index of their hash, as encoding does. A table beyond
``LOOKUP_MAX`` types is joined with the distinct types before the borders of each text instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.functions import text as T
from glossa.operators.scale import join_table
from glossa.operators.vocab import LOOKUP_MAX, _slot, lookup_table
from glossa.session import materialize

# --- fixed values ------------------------------------------------------------
P_ABBREVIATION = 0.99        # chance of a period after an abbreviation
THRESHOLD = 0.3              # least weighted log-likelihood ratio of an abbreviation
OPENING = r"^[\"'(\[{«„“‘]+"   # marks before a word that are no part of it
BORDER_WITH_BLANKS = "([.!?])(" + T.WS + "+)"
LANG_SEP = "\u0002"
# -----------------------------------------------------------------------------


def _bare(token: Column) -> Column:
    """The type of a token: lower case, without opening marks and without one period at its end."""
    return F.regexp_replace(F.regexp_replace(F.lower(token), OPENING, ""), r"\.$", "")


def _log_likelihood(k: Column, n: Column, p: Column) -> Column:
    return k * F.log(p) + (n - k) * F.log(F.lit(1.0) - p)


def abbreviation_score(n_period: Column, n_plain: Column, period_share: Column, word_type: Column) -> Column:
    """Weight of ``word_type``, seen ``n_period`` times with and ``n_plain`` times without a period, in a
    language where ``period_share`` of all tokens end with one."""
    n = n_period + n_plain
    ratio = F.lit(2.0) * (_log_likelihood(n_period, n, F.lit(P_ABBREVIATION)) - _log_likelihood(n_period, n, period_share))
    inner = F.length(word_type) - F.length(F.regexp_replace(word_type, r"\.", ""))
    letters = (F.length(word_type) - inner).cast("double")
    return ratio * F.exp(-letters) * (inner + F.lit(1)) * F.pow(letters, -n_plain)


def learn_abbreviations(df: DataFrame, text_col: str, lang_col: str, threshold: float = THRESHOLD) -> DataFrame:
    """``lang, token, n_period, n_plain, score`` of the abbreviations of each language (null is a language
    of its own). Types are counted over all texts; only types with a letter count. A language whose tokens
    never or always end with a period has none. Written once, as every user reads it twice."""
    token = F.explode_outer(F.filter(F.split(F.regexp_replace(F.col(text_col), T.WS + "+", " "), " "), lambda t: t != F.lit("")))
    t = df.select(F.col(lang_col).alias("lang"), token.alias("t")).where(F.col("t").isNotNull())
    t = t.select("lang", _bare(F.col("t")).alias("token"), F.col("t").endswith(".").cast("long").alias("p"))
    counts = materialize(t.groupBy("lang", "token").agg(F.sum("p").alias("n_period"), F.sum(F.lit(1) - F.col("p")).alias("n_plain")))
    share = counts.groupBy("lang").agg((F.sum("n_period") / F.sum(F.col("n_period") + F.col("n_plain"))).alias("_share"))
    c = join_table(counts.where((F.col("n_period") > 0) & F.col("token").rlike(r"\p{L}")),
                   share.where((F.col("_share") > 0) & (F.col("_share") < 1)), ["lang"])
    score = abbreviation_score(F.col("n_period").cast("double"), F.col("n_plain").cast("double"), F.col("_share"), F.col("token"))
    return materialize(c.withColumn("score", score).where(F.col("score") >= threshold)
                       .select("lang", "token", "n_period", "n_plain", "score"))


def _key(lang: Column, token: Column) -> Column:
    return F.concat(F.coalesce(lang, F.lit(LANG_SEP)), F.lit(LANG_SEP), token)


def _merged(pieces: str, joined: Column) -> Column:
    """Sentences: ``pieces`` (each but the first begins with its blanks) put together where ``joined`` says that
    the border after a piece is none. Pieces and borders go side by side as arguments of one function: inside a lambda
    the optimiser would put the expression of ``joined`` in place of its column and compute it once a piece."""
    after = F.concat(F.array(F.lit(True)), joined)            # whether a piece goes on the sentence before it
    marked = F.zip_with(pieces, after, lambda p, on: F.when(on, p).otherwise(
        F.concat(F.lit(T.SENTENCE_SEP), F.regexp_replace(p, "^" + T.WS + "+", ""))))
    return F.split(F.array_join(marked, ""), T.SENTENCE_SEP, -1)


def split_sentences(df: DataFrame, text_col: str, lang_col: str, abbreviations: DataFrame, id_col: str,
                    out: str = "sentences", lookup_max: int = LOOKUP_MAX) -> DataFrame:
    """Add ``out``: the sentences of each text as T9 splits it, but not after a type that ``abbreviations``
    lists for the text's language. Null texts give null, empty ones one empty sentence. Blanks inside a sentence
    stay as they are; those at a border are dropped.
    ``id_col`` must be unique only if the table has more than ``lookup_max`` types."""
    marked = F.regexp_replace(F.col(text_col), BORDER_WITH_BLANKS, "$1" + T.SENTENCE_SEP + "$2")
    last = lambda p: _bare(F.regexp_replace(p, "(?s)^.*" + T.WS, ""))      # noqa: E731
    d = df.withColumn("_pieces", F.split(marked, T.SENTENCE_SEP, -1))
    piece_keys = F.transform("_pieces", lambda p: F.when(p.endswith("."), _key(F.col(lang_col), last(p))))
    keys = abbreviations.select(_key(F.col("lang"), F.col("token")).alias("token"), F.lit(1).alias("token_id"))
    n = keys.limit(lookup_max + 1).count()
    if n <= lookup_max:
        slots = max(16, 1 << (2 * max(n, 1) - 1).bit_length())
        # read once and not kept, so the optimiser puts it into the expression: as a column each row would copy the table
        d = d.withColumn("_table", lookup_table(keys, slots).scalar())
        hit = F.transform(piece_keys, lambda k: F.coalesce(F.element_at(F.get("_table", _slot(k, slots)), k) == 1, F.lit(False)))
    else:
        d = d.withColumn("_keys", piece_keys)
        found = (d.select(F.col(id_col).alias("_id"), F.explode(F.array_distinct("_keys")).alias("token")).where(F.col("token").isNotNull())
                 .join(keys, "token").groupBy("_id").agg(F.collect_set("token").alias("_found")))
        d = d.join(found, F.col(id_col).eqNullSafe(F.col("_id")), "left").drop("_id")
        hit = F.transform("_keys", lambda k: F.coalesce(F.array_contains("_found", k), F.lit(False)))
    return d.select(*[c for c in df.columns if c != out], _merged("_pieces", hit).alias(out))
