"""Seeded shuffles, caps, class balance, stratified chunks and folds
(L1-L3, G1-G7, U2, U3, W2).

"Random" always means the md5 uniform ``u(seed, id)``: the same rows are drawn
whatever the partitioning or retries. Row numbers in that order come from the
bucketed row number in ``scale`` (no single-task window), so a stratum that
holds a third of all rows is still numbered by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.functions import rand
from glossa.operators.scale import join_table, prefix_key, row_number_by_uniform, with_exclusive_prefix
from glossa.session import materialize

# --- fixed values ------------------------------------------------------------
SEED = 5353
N_FOLDS = 10                 # fold downsample modulus
HOLDOUT_FRACTION = 0.1
FOLD_RUNS = 4                # fold models; fold f reads chunk f of each file below
FOLD_ORIGINS = ("subtitle", "foreign")
BASE_CHUNKS = {"foreign": 6, "english": 2}      # the base model reads the first chunks of these files
# -----------------------------------------------------------------------------


def with_shuffle_key(df: DataFrame, id_col: str, seed: int = SEED, out: str = "shuffle_key") -> DataFrame:   # L1
    return df.withColumn(out, rand.uniform(seed, F.col(id_col)))


def shuffle_positions(df: DataFrame, id_col: str, seed: int = SEED, part_cols: Sequence[str] = (),
                      out: str = "pos") -> DataFrame:                                            # L1 / W2
    """1-based position of each row in the seeded shuffle (per ``part_cols``)."""
    d = with_shuffle_key(df, id_col, seed, "_u")
    return row_number_by_uniform(d, "_u", [id_col], part_cols, out_col=out).drop("_u")


def take_shuffled(df: DataFrame, n: int, id_col: str, seed: int = SEED) -> DataFrame:          # L2 / L3
    """The first ``n`` rows of the seeded shuffle (all rows when fewer)."""
    d = with_shuffle_key(df, id_col, seed, "_u")
    return row_number_by_uniform(d, "_u", [id_col], out_col="_rn").where(F.col("_rn") <= n).drop("_u", "_rn")


def class_balance(df: DataFrame, label_col: str, ratio: int, id_col: str, file_col: str | None = None,
                  seed: int = SEED) -> DataFrame:                                                 # G1
    """All positives plus ``min(pos * ratio, neg)`` negatives drawn without
    replacement, per input file. The input is run and written once: counts and order both read it."""
    keys = [file_col] if file_col else []
    df = materialize(df)
    counts = df.groupBy(*keys).agg(F.sum(F.when(F.col(label_col) == 1, 1).otherwise(0)).alias("_p"),
                                   F.sum(F.when(F.col(label_col) == 0, 1).otherwise(0)).alias("_n"))
    caps = counts.select(*keys, F.least(F.col("_p") * F.lit(ratio), F.col("_n")).alias("_cap"))
    d = shuffle_positions(df.where(F.col(label_col).isin(0, 1)), id_col, seed, [*keys, label_col], out="_rn")
    d = join_table(d, caps, keys) if keys else d.withColumn("_cap", caps.select("_cap").scalar())
    return d.where((F.col(label_col) == 1) | (F.col("_rn") <= F.col("_cap"))).drop("_rn", "_cap")


def stratified_chunks(df: DataFrame, strata_col: str, chunk_size: int, id_col: str,
                      seed: int = SEED, out: str = "chunk") -> DataFrame:                          # G2
    """``k = rows // chunk_size`` stratified chunks (one chunk 0 unless k > 2).

    Strata are sorted; the r-th row (seeded order) of a stratum whose sorted
    predecessors hold O rows goes to chunk ``(O + r - 1) % k``, which gives
    every (chunk, stratum) the size of the unshuffled stratified k-fold split."""
    # one row a stratum; their running sum is bucketed too, so any number of strata does
    counts = df.groupBy(strata_col).agg(F.count(F.lit(1)).alias("_sn"))
    text = dict(df.dtypes)[strata_col] == "string"
    key = prefix_key(F.col(strata_col)) if text else F.col(strata_col).cast("double")
    counts = materialize(counts.withColumn("_key", key))
    k = F.floor(counts.select(F.sum("_sn")).scalar() / F.lit(chunk_size))
    offs = with_exclusive_prefix(counts, [strata_col], ["_sn"], bucket_col="_key")
    offs = offs.select(strata_col, F.col("_sn_before").alias("_off"))
    d = join_table(shuffle_positions(df, id_col, seed, [strata_col], out="_rn"), offs, [strata_col])
    chunk = F.when(k > 2, F.pmod(F.col("_off") + F.col("_rn") - 1, k)).otherwise(F.lit(0))
    return d.withColumn(out, chunk.cast("int")).drop("_rn", "_off")


def chunk_cap(df: DataFrame, max_chunk: int | None, chunk_col: str = "chunk") -> DataFrame:   # G3
    return df if max_chunk is None else df.where(F.col(chunk_col) < max_chunk)


def route_runs(chunked: DataFrame, pseudo: DataFrame, id_col: str = "id", n_folds: int = FOLD_RUNS) -> DataFrame:      # G7
    """``run, origin, id``: the rows on which each run trains. ``chunked`` has ``origin`` (subtitle, foreign or
    english), ``chunk`` and the id. The base run reads the first chunks of the foreign and the English
    file, the run of fold f the pseudo-labelled rows and chunk f of the subtitle and the foreign file.
    A row names its runs in one projection, so each table is read once for all runs."""
    base = F.lit(False)
    for origin, n in BASE_CHUNKS.items():
        base = base | ((F.col("origin") == origin) & (F.col("chunk") < n))
    fold = F.col("origin").isin(*FOLD_ORIGINS) & (F.col("chunk") < n_folds)
    runs = F.array_compact(F.array(F.when(base, F.lit("base")), F.when(fold, F.concat(F.lit("fold"), F.col("chunk").cast("string")))))
    every = F.array(*[F.lit(f"fold{f}") for f in range(n_folds)])
    routed = chunked.select(F.explode(runs).alias("run"), "origin", id_col)
    return routed.unionByName(pseudo.select(F.explode(every).alias("run"), F.lit("pseudo").alias("origin"), id_col))


def fold_downsample(df: DataFrame, fold: int, label_col: str, id_col: str, part_cols: Sequence[str] = ("lang",),
                    seed: int = SEED, n_folds: int = N_FOLDS) -> DataFrame:                         # G4 / W2
    """All positives plus the negatives whose 0-based shuffled index (per
    ``part_cols``) is ``fold`` modulo ``n_folds``."""
    d = shuffle_positions(df.where(F.col(label_col).isin(0, 1)), id_col, seed, [*part_cols, label_col], out="_rn")
    return d.where((F.col(label_col) == 1) | (F.pmod(F.col("_rn") - 1, F.lit(n_folds)) == fold)).drop("_rn")


def equal_class_downsample(df: DataFrame, class_cols: Sequence[str], id_col: str, seed: int = SEED) -> DataFrame:   # G5
    """Cut every class to the size of the smallest class. Rows without a class are left out first."""
    class_cols = list(class_cols)
    df = materialize(df.dropna(subset=class_cols))          # read for the class sizes and for the order
    smallest = df.groupBy(*class_cols).agg(F.count(F.lit(1)).alias("_c")).select(F.min("_c")).scalar()
    d = shuffle_positions(df, id_col, seed, class_cols, out="_rn")
    return d.where(F.col("_rn") <= smallest).drop("_rn")


def holdout_split(df: DataFrame, id_col: str, fraction: float = HOLDOUT_FRACTION, seed: int = SEED,
                  out: str = "split") -> DataFrame:                                                 # G6
    """The first ``ceil(fraction * n)`` rows of the seeded order are 'holdout'."""
    n = df.select(F.count(F.lit(1))).scalar()
    d = shuffle_positions(df, id_col, seed, out="_rn")
    return d.withColumn(out, F.when(F.col("_rn") <= F.ceil(n * F.lit(fraction)), "holdout").otherwise("train")) \
        .drop("_rn")


def dedupe_keep_first(df: DataFrame, key_cols, id_col: str) -> DataFrame:                        # U2
    """One row per ``key_cols``: the one with the smallest ``id_col`` (unique).
    Partial aggregation collapses a hot key before the shuffle. Each column is
    its own ``min_by`` on the id, so fixed-width columns keep the hash
    aggregate (a struct buffer would force a sort-based one)."""
    key_cols = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    others = [c for c in df.columns if c not in key_cols]
    aggs = [F.min(id_col).alias(c) if c == id_col else F.min_by(c, F.col(id_col)).alias(c) for c in others]
    return df.groupBy(*key_cols).agg(*aggs).select(*key_cols, *others)
