"""Global prefix sums, percentile ranks and row numbers without a one-task window.

A window with no PARTITION BY moves every row into one task. Here every global
order-dependent quantity is built from three distributed pieces instead:

1. a *bucket* per row that is monotone in the order key: ``floor(u * B)`` for
   uniform keys, or approximate-quantile splits otherwise;
2. a running sum *within* (partition, bucket) -- a window whose partitions are
   the buckets, so the work spreads over B tasks;
3. an exclusive prefix over the per-bucket totals -- a table of at most
   ``#partitions x B`` rows -- joined back on (partition, bucket).

Hot values are collapsed first (``groupBy(value).count()`` with map-side
partial aggregation), so a value holding a third of all rows is one row here.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossa.session import materialize

_B = "_bucket"
BROADCAST_ROWS = 10_000     # a table of at most this many narrow rows may be broadcast


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a null key matches a null key, so grouped values find their rows again."""
    other = right.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return left.join(other, on, how).drop(*[f"_k_{k}" for k in keys])


def join_table(df: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Null-safe join with a table that normally has few rows (one per file, stratum, language,
    ...). It is written once and counted: up to ``BROADCAST_ROWS`` rows it is broadcast, so ``df`` is not
    shuffled on a few hot keys; beyond, there are many keys and a join by sorting spreads them. That is asked for:
    a written table of numbers has so few bytes that it would be broadcast, with all its rows in the driver."""
    table = materialize(table)
    small = table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return null_safe_join(df, table.hint("broadcast" if small else "merge"), keys, how)


def default_buckets(df: DataFrame) -> int:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(16, 2 * n)


def quantile_bucket(df: DataFrame, col: str, n_buckets: int | None = None) -> DataFrame:
    """Add ``_bucket``: a bucket index monotone in ``col``, with buckets of about
    equal numbers of rows of ``df``.

    The split points are one ``percentile_approx`` scalar subquery (bounded
    sketch, planned lazily with the query, evaluated once); the lookup is a
    binary search unrolled into log2(n_buckets) projections, so each row costs
    that many comparisons inside generated code.
    """
    nb = n_buckets or default_buckets(df)
    k = max(1, math.ceil(math.log2(nb)))
    width = (1 << k) - 1                                   # split count
    probs = [i / float(width + 1) for i in range(1, width + 1)]
    v = F.col(col).cast("double")
    splits = df.select(F.percentile_approx(v, probs, 4 * (width + 1)).alias("s")).scalar()
    # The subquery is referenced once, in its own column: every reference would
    # otherwise be a separate subquery that re-reads ``df`` to build a sketch.
    d = df.withColumn("_splits", splits).withColumn(_B, F.lit(0))
    n = F.size("_splits")
    for i in range(k):                       # binary search: count of splits <= v
        half = F.lit(1 << (k - 1 - i))
        nxt = F.col(_B) + half
        d = d.withColumn(_B, F.when((nxt <= n) & (F.element_at("_splits", nxt) <= v), nxt).otherwise(F.col(_B)))
    return d.withColumn(_B, F.col(_B).cast("int")).drop("_splits")


def prefix_key(text: Column) -> Column:
    """A double non-decreasing in the byte order of ``text``: its first six UTF-8 bytes as a number."""
    return F.conv(F.rpad(F.hex(F.substring(F.encode(text, "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double")


def with_exclusive_prefix(df: DataFrame, order_cols: Sequence[str], sum_cols: Sequence[str],
                          part_cols: Sequence[str] = (), bucket: Column | None = None,
                          n_buckets: int | None = None, totals: bool = False,
                          bucket_col: str | None = None) -> DataFrame:
    """For each row add ``<c>_before``: sum of ``c`` over rows of the same
    ``part_cols`` group whose ``order_cols`` key is strictly smaller.

    ``(part_cols, order_cols)`` must be unique. ``bucket`` is an int Column that
    is non-decreasing in the order key; default is quantile buckets of
    ``bucket_col`` (a numeric column non-decreasing in the order key; default
    the first order column). With ``totals`` also add ``<c>_total`` per group.
    """
    part_cols = list(part_cols)
    if bucket is None:
        d = quantile_bucket(df, bucket_col or order_cols[0], n_buckets)
    else:
        d = df.withColumn(_B, bucket.cast("int"))
    keys = part_cols + [_B]
    w_in = (Window.partitionBy(*keys).orderBy(*order_cols)
            .rowsBetween(Window.unboundedPreceding, -1))
    # totals by partial aggregation: no window buffers a whole bucket for them
    bt = d.groupBy(*keys).agg(*[F.sum(c).alias(f"_{c}_bt") for c in sum_cols])
    d = d.select("*", *[F.coalesce(F.sum(c).over(w_in), F.lit(0)).alias(f"_{c}_in") for c in sum_cols])
    # At most (#groups x n_buckets) rows; without part_cols this window sees
    # n_buckets rows only.
    w_off = Window.partitionBy(*part_cols).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    offs = [F.coalesce(F.sum(f"_{c}_bt").over(w_off), F.lit(0)).alias(f"_{c}_off") for c in sum_cols]
    if totals:
        w_tot = Window.partitionBy(*part_cols)
        offs += [F.sum(f"_{c}_bt").over(w_tot).alias(f"{c}_total") for c in sum_cols]
    bt = bt.select(*keys, *offs)
    if not part_cols:
        out = d.join(F.broadcast(bt), on=keys, how="inner")      # n_buckets rows: size is bounded by construction
    else:
        out = join_table(d, bt, keys)
    for c in sum_cols:
        out = out.withColumn(f"{c}_before", F.col(f"_{c}_off") + F.col(f"_{c}_in"))
    return out.drop(_B, *[f"_{c}_in" for c in sum_cols], *[f"_{c}_off" for c in sum_cols])


def pct_rank(df: DataFrame, value_col: str, out_col: str, part_cols: Sequence[str] = (),
             n_buckets: int | None = None) -> DataFrame:
    """pandas ``rank(pct=True)`` (average ties): ``(below + (ties + 1) / 2) / n``,
    ``n`` = non-null values of the group; null in, null out. ``df`` is written once (pass only
    the columns that are needed): the value counts and the join back both read it. The join back
    shuffles no row of a heavy value."""
    part_cols = list(part_cols)
    df = materialize(df)
    vals = (df.where(F.col(value_col).isNotNull())
            .groupBy(*part_cols, value_col).agg(F.count(F.lit(1)).alias("_n")))
    vals = materialize(vals)          # read by the sketch, the windows and the join
    nb = n_buckets or default_buckets(df)
    n_all = vals.select(F.sum("_n")).scalar()
    vals = with_exclusive_prefix(vals, [value_col], ["_n"], part_cols, n_buckets=n_buckets, totals=True)
    vals = vals.select(*part_cols, value_col,
                       ((F.col("_n_before") + (F.col("_n") + F.lit(1)) / F.lit(2.0)) / F.col("_n_total")).alias(out_col),
                       (F.col("_n") * F.lit(nb) > n_all).alias("_heavy"))
    return _join_by_value(df, vals, [*part_cols, value_col], value_col)


def _join_by_value(df: DataFrame, vals: DataFrame, keys: list[str], value_col: str) -> DataFrame:
    """Left join of ``df`` with one row a value. Rows without a value and rows of a ``_heavy`` value are never
    shuffled: a heavy value holds more than 1/n_buckets of all rows, so fewer than n_buckets are broadcast."""
    heavy = null_safe_join(df, F.broadcast(vals.where("_heavy")), keys, "left")
    apart = F.col("_heavy").isNotNull() | F.col(value_col).isNull()
    light = null_safe_join(heavy.where(~apart).select(*df.columns), vals.where(~F.col("_heavy")), keys, "left")
    return heavy.where(apart).drop("_heavy").unionByName(light.drop("_heavy"))


def row_number_by_uniform(df: DataFrame, u_col: str, tie_cols: Sequence[str],
                          part_cols: Sequence[str] = (), out_col: str = "rn",
                          n_buckets: int | None = None) -> DataFrame:
    """1-based row number within ``part_cols`` in the order ``(u_col, *tie_cols)``,
    where ``u_col`` is uniform on [0, 1). Equal-width buckets of ``u`` are balanced
    by construction, so a hot group is still spread over ``n_buckets`` tasks."""
    nb = n_buckets or default_buckets(df)
    bucket = F.least(F.floor(F.col(u_col) * F.lit(nb)), F.lit(nb - 1))
    d = df.withColumn("_one", F.lit(1))
    d = with_exclusive_prefix(d, [u_col, *tie_cols], ["_one"], part_cols, bucket=bucket)
    return d.withColumn(out_col, F.col("_one_before") + F.lit(1)).drop("_one", "_one_before")
