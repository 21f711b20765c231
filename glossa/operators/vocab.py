"""Vocabulary build (K2) and id encoding (K1) as Spark jobs.

The vocabulary is the ``size`` most frequent tokens (ties by token), id =
rank + 3. Encoding is a projection: the vocabulary (at most ``size`` rows, a
parameter) becomes one array of hash buckets, a scalar subquery, and each token
is looked up by the index of its hash. Nothing is exploded, joined or collected
per token. Vocabularies beyond ``LOOKUP_MAX`` rows are joined instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossa.functions.tokens import UNK
from glossa.operators.scale import prefix_key, with_exclusive_prefix
from glossa.session import materialize

# Vocabularies up to this many entries are broadcast; larger ones use a
# shuffled join (AQE splits hot tokens).
BROADCAST_VOCAB_MAX = 2_000_000
# Vocabularies up to this many entries become a lookup table in the projection
# (some 30 bytes an entry in each task).
LOOKUP_MAX = 500_000


def _order_bucket_key(n: Column, token: Column) -> Column:
    """A double that is non-decreasing in the order ``(n desc, token asc)``:
    ``-n * 2^48`` plus the first 6 UTF-8 bytes of the token read as a number
    (byte order is Spark's string order; rounding keeps monotonicity). Tokens
    of one count are therefore spread over buckets by their prefix."""
    return -n.cast("double") * F.lit(float(1 << 48)) + prefix_key(token)


def build_vocab(df: DataFrame, tokens_col: str, size: int) -> DataFrame:
    """``(token, token_id)`` for the ``size`` most frequent tokens (ties by token), id = rank + 3.
    Token counts are ranked in buckets, so no task sees them all. Written once: every reader of
    the vocabulary reads this table."""
    # explode_outer + a filter on the generated column: an inner explode makes
    # Catalyst infer ``size(tokens) > 0`` and push it below the projection,
    # which would evaluate the whole tokeniser twice per row.
    counts = (df.select(F.explode_outer(tokens_col).alias("token")).where(F.col("token").isNotNull())
              .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    c = counts.withColumn("_neg_n", -F.col("n")).withColumn("_one", F.lit(1))
    c = materialize(c.withColumn("_key", _order_bucket_key(F.col("n"), F.col("token"))))
    c = with_exclusive_prefix(c, ["_neg_n", "token"], ["_one"], bucket_col="_key")
    ranked = c.select("token", (F.col("_one_before") + F.lit(1)).alias("_rank"))
    return materialize(ranked.where(F.col("_rank") <= size).select(
        "token", (F.col("_rank") + F.lit(UNK)).cast("int").alias("token_id")))


def _slot(token: Column, n_slots: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(n_slots)).cast("int")


def lookup_table(vocab: DataFrame, n_slots: int) -> DataFrame:
    """One row with ``table``: an array of ``n_slots`` maps (null where no token falls), token -> id.
    A token is in the map at the place of its hash, so a lookup reads a map of one or two entries."""
    slots = (vocab.groupBy(_slot(F.col("token"), n_slots).alias("slot"))
             .agg(F.map_from_entries(F.collect_list(F.struct("token", "token_id"))).alias("m")))
    every = vocab.sparkSession.range(n_slots).select(F.col("id").cast("int").alias("slot")).join(slots, "slot", "left")
    return every.agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", F.struct("m").alias("e"))),
                                              lambda a, b: a["slot"] - b["slot"]), lambda s: s["e"]["m"]).alias("table"))


def _encode_in_place(df: DataFrame, key_col: str, tok: Column, vocab: DataFrame, carry: list, n_slots: int, out_col: str,
                     max_tokens: int | None, below: int | None) -> DataFrame:
    table = lookup_table(vocab, n_slots)
    d = df.select(key_col, *carry, tok.alias("_toks"))
    # the token array and the table are bound to columns, so the tokeniser runs once a row and the subquery once a query
    d = d.select(key_col, *carry, F.greatest(F.size("_toks"), F.lit(0)).alias("n_tokens"), "_toks")
    if below is not None:
        d = d.where(F.col("n_tokens") < below)
    kept = F.col("_toks") if max_tokens is None else F.slice("_toks", 1, max_tokens)
    d = d.select(key_col, *carry, "n_tokens", F.coalesce(kept, F.array().cast("array<string>")).alias("_kept"), table.scalar().alias("_table"))
    ids = F.transform("_kept", lambda t: F.coalesce(F.element_at(F.get("_table", _slot(t, n_slots)), t), F.lit(UNK)))
    return d.select(key_col, *carry, "n_tokens", ids.alias(out_col))


def encode_ids(df: DataFrame, key_col: str, tokens, vocab: DataFrame,
               carry: Sequence[str] = (), vocab_size: int | None = None,
               out_col: str = "raw_ids", max_tokens: int | None = None, below: int | None = None) -> DataFrame:
    """Map each document's tokens to ids (unknown = 3), keeping token order.

    ``tokens`` is a column name or a Column expression over ``df`` (e.g. ``word_tokens('comment_text')``).
    With ``below`` documents of that many tokens or more are left out, with ``max_tokens`` the tokens
    beyond are cut, both before any lookup. Returns ``key_col, *carry, n_tokens, out_col`` (``n_tokens``
    counts all tokens of the document), one row for each row of ``df``. With ``vocab_size`` up to
    ``LOOKUP_MAX`` that is a projection of ``df``. Larger vocabularies are joined: then tokens become
    rows, ``key_col`` must be unique, and ``carry`` columns functionally dependent on it."""
    carry = list(carry)
    tok = F.col(tokens) if isinstance(tokens, str) else tokens
    if vocab_size is not None and vocab_size <= LOOKUP_MAX:
        slots = max(16, 1 << (2 * vocab_size - 1).bit_length())
        return _encode_in_place(df, key_col, tok, vocab, carry, slots, out_col, max_tokens, below)
    d = df.select(key_col, *carry, tok.alias("_toks")).select(
        key_col, *carry, F.greatest(F.size("_toks"), F.lit(0)).alias("n_tokens"), "_toks")
    if below is not None:
        d = d.where(F.col("n_tokens") < below)
    kept = F.col("_toks") if max_tokens is None else F.slice("_toks", 1, max_tokens)
    ex = d.select(key_col, *carry, "n_tokens", F.posexplode_outer(kept).alias("pos", "token"))
    v = vocab.select("token", "token_id")
    if vocab_size is not None and vocab_size <= BROADCAST_VOCAB_MAX:
        v = F.broadcast(v)
    j = ex.join(v, on="token", how="left")
    item = F.when(F.col("pos").isNotNull(),
                  F.struct(F.col("pos"), F.coalesce(F.col("token_id"), F.lit(UNK)).alias("tid")))
    # every document has one row at position 0 (null when it has no token): two mean two documents
    firsts = F.sum(F.when(F.coalesce(F.col("pos"), F.lit(0)) == 0, 1).otherwise(0))
    repeated = F.raise_error(F.concat(F.lit(f"encode_ids: {key_col} is not unique: "), F.first(F.col(key_col).cast("string"))))
    items = F.array_sort(F.collect_list(item))
    g = j.groupBy(key_col, *carry).agg(F.max("n_tokens").alias("n_tokens"), F.when(firsts > 1, repeated).otherwise(items).alias("_items"))
    return g.select(key_col, *carry, "n_tokens", F.transform("_items", lambda s: s["tid"]).alias(out_col))
