"""Seeded text augmentation (AU1-AU4) as column expressions and joins.

Every draw is an md5 uniform keyed by (seed, row id, step[, position]), so
results do not depend on row order or partitioning. Synthetic mixing draws
pool rows by *index*: the pool is numbered 0..n-1 per (lang, label) and draws
are equi-joined on (lang, label, index) -- the pool is never collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.functions import rand
from glossa.functions import text as T
from glossa.operators.scale import join_table, row_number_by_uniform
from glossa.session import materialize

# --- fixed values ------------------------------------------------------------
SEED = 42
CLEAN_P = 0.95                 # probability of each cleaning step
CLEAN_STEPS = ("mentions", "urls", "numbers", "hashtags", "duplicate_sentences")
MIX_P = 0.5                    # probability of synthetic mixing
NON_TOXIC_DRAWS_IF_0 = (1, 5)  # inclusive ranges of draws
NON_TOXIC_DRAWS_IF_1 = (0, 2)
TOXIC_DRAWS_IF_1 = (1, 3)
MAX_LENGTH = 224
LONG_FRACTION = 0.8            # token length > 0.8 * MAX_LENGTH -> sentence shuffle
SHORT_LENGTH = 60              # token length < 60 -> synthetic mixing
# -----------------------------------------------------------------------------


def _step(step: str, c: Column) -> Column:
    if step == "mentions":
        return T.collapse_ws(T.strip_mentions(c))
    if step == "urls":
        return T.collapse_ws(T.strip_urls(c))
    if step == "numbers":
        return T.strip_numbers(c)
    if step == "hashtags":
        return T.collapse_ws(T.strip_hashtags(c))
    return T.dedupe_sentences(c)


def clean_chain(df: DataFrame, text_col: str, id_col: str, seed: int = SEED, out: str = "text") -> DataFrame:   # AU1
    """Each cleaning step applied with probability 0.95, in order."""
    d = df.withColumn(out, F.col(text_col))
    for step in CLEAN_STEPS:
        hit = rand.uniform(seed, F.col(id_col), step) < F.lit(CLEAN_P)
        d = d.withColumn(out, F.when(hit, _step(step, F.col(out))).otherwise(F.col(out)))
    return d


def shuffle_sentences(text, key, seed: int = SEED, pieces=None) -> Column:                        # AU2
    """Sentences in a seeded random order, joined by one blank. ``pieces``: the sentences of the text as an
    array, if split otherwise than by T9 (``operators.sentences``)."""
    keyed = F.transform(T.sentences(text) if pieces is None else pieces, lambda s, i: F.struct(rand.uniform(seed, key, "shuf", i).alias("k"),
                                                                  s.alias("s")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda x: x["s"]), " ")


def word_count(text) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.size(F.filter(F.split(T.collapse_ws(c), " ", -1), lambda t: t != F.lit("")))


def token_length(text) -> Column:
    """Attention-mask length of the text encoded to MAX_LENGTH (marks included)."""
    return F.least(word_count(text) + F.lit(2), F.lit(MAX_LENGTH))


def numbered_pool(pool: DataFrame, seed: int = SEED) -> DataFrame:
    """``lang, toxic, idx (0-based), comment_text`` numbered per (lang, toxic)."""
    d = pool.withColumn("_u", rand.uniform(seed, F.col("id")))
    d = row_number_by_uniform(d, "_u", ["id"], ["lang", "toxic"], out_col="_rn")
    return d.select("lang", "toxic", (F.col("_rn") - 1).alias("idx"), "comment_text")


def _seq(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(1), n.cast("int"))).otherwise(F.array().cast("array<int>"))


def _draws(lo_hi, u: Column) -> Column:
    lo, hi = lo_hi
    return (F.floor(u * F.lit(hi - lo + 1)) + F.lit(lo)).cast("int")


def synthetic_mix(rows: DataFrame, pool: DataFrame, id_col="id", text_col="text", label_col="toxic",
                  seed: int = SEED, p: float = MIX_P, out: str = "text") -> DataFrame:             # AU3
    """With probability ``p`` append random pool texts of the same language
    (label 0: 1-5 non-toxic; label 1: 0-2 non-toxic and 1-3 toxic) and shuffle
    the pieces; the label is unchanged. Rows keep all other columns."""
    # read twice below (class sizes, piece lookup): written once to shared storage
    npool = materialize(numbered_pool(pool, seed))
    sizes = npool.groupBy("lang").agg(F.sum(F.when(F.col("toxic") == 0, 1).otherwise(0)).alias("_n0"),
                                      F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("_n1"))
    key = F.col(id_col)
    mix = rand.uniform(seed, key, "mix") < F.lit(p)
    y = F.col(label_col)
    n_nt = F.when(y == 0, _draws(NON_TOXIC_DRAWS_IF_0, rand.uniform(seed, key, "n_nt"))) \
        .otherwise(_draws(NON_TOXIC_DRAWS_IF_1, rand.uniform(seed, key, "n_nt")))
    n_t = F.when(y == 0, F.lit(0)).otherwise(_draws(TOXIC_DRAWS_IF_1, rand.uniform(seed, key, "n_t")))
    kept = rows.where(~mix)
    m = join_table(rows.where(mix), sizes.where("lang is not null"), ["lang"], "left")
    m = m.withColumn("_n_nt", F.when(F.col("_n0") > 0, n_nt).otherwise(0)) \
         .withColumn("_n_t", F.when(F.col("_n1") > 0, n_t).otherwise(0))
    plan = F.concat(
        F.array(F.struct(F.lit(-1).alias("cls"), F.lit(0).alias("j"))),
        F.transform(_seq(F.col("_n_nt")), lambda j: F.struct(F.lit(0).alias("cls"), j.alias("j"))),
        F.transform(_seq(F.col("_n_t")), lambda j: F.struct(F.lit(1).alias("cls"), j.alias("j"))))
    carry = [c for c in rows.columns if c not in (id_col, text_col)]
    ex = m.select(id_col, *carry, F.col(text_col).alias("_self"), "_n0", "_n1", F.explode_outer(plan).alias("d"))
    cls, j = F.col("d.cls"), F.col("d.j")
    size = F.when(cls == 0, F.col("_n0")).otherwise(F.col("_n1"))
    ex = ex.select(id_col, *carry, F.when(cls < 0, F.col("_self")).alias("_self"),
                   F.when(cls >= 0, cls).alias("_cls"),
                   F.when(cls >= 0, F.floor(rand.uniform(seed, key, "draw", cls, j) * size).cast("long")).alias("_idx"),
                   rand.uniform(seed, key, "perm", cls, j).alias("_k"))
    pj = npool.select(F.col("lang").alias("_lang"), F.col("toxic").alias("_cls"), F.col("idx").alias("_idx"),
                      F.col("comment_text").alias("_piece"))
    ex = ex.join(pj, (ex["lang"] == pj["_lang"]) & (ex["_cls"] == pj["_cls"]) & (ex["_idx"] == pj["_idx"]), "left")
    piece = F.struct(F.col("_k").alias("k"), F.coalesce(F.col("_piece"), F.col("_self")).alias("s"))
    g = ex.groupBy(id_col, *carry).agg(F.array_sort(F.collect_list(piece)).alias("_pieces"))
    mixed = g.select(id_col, *carry, F.array_join(F.transform("_pieces", lambda x: x["s"]), " ").alias(out))
    return kept.withColumnRenamed(text_col, out).select(mixed.columns).unionByName(mixed)


def length_router(df: DataFrame, pool: DataFrame, id_col="id", text_col="comment_text", label_col="toxic",
                  seed: int = SEED) -> DataFrame:                                                    # AU4
    """AU1, then by token length: long -> sentence shuffle, short -> synthetic
    mixing, otherwise unchanged. Adds ``route``; only short rows meet the pool."""
    d = clean_chain(df, text_col, id_col, seed, out="text").drop(text_col)
    n = token_length("text")
    route = (F.when(n > F.lit(LONG_FRACTION * MAX_LENGTH), "shuffle")
             .when(n < F.lit(SHORT_LENGTH), "mix").otherwise("keep"))
    # Three branches read the routed rows; filters on ``route`` would otherwise
    # re-inline the whole cleaning chain into every branch.
    d = materialize(d.withColumn("route", route))
    longs = d.where(F.col("route") == "shuffle").withColumn("text", shuffle_sentences("text", F.col(id_col), seed))
    keeps = d.where(F.col("route") == "keep")
    shorts = synthetic_mix(d.where(F.col("route") == "mix"), pool, id_col, "text", label_col, seed)
    return longs.unionByName(keeps).unionByName(shorts.select(longs.columns))
