"""Counts, checks and evaluation metrics.

ROC AUC is exact and distributed: rows collapse to one per distinct score with
positive/negative counts (map-side partial aggregation), the negatives below
each score come from the bucketed prefix sum in ``scale``, and the final sum
is a plain aggregate. Ties count one half.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossa.operators.scale import join_table, quantile_bucket, with_exclusive_prefix
from glossa.session import materialize

# --- fixed values ------------------------------------------------------------
N_THRESHOLDS = 200                 # binned AUC thresholds
ACCURACY_CUT = 0.5
LOGLOSS_EPS = 1e-7
LABEL_SMOOTHING = 0.1
PRIOR_ROWS = ((0, 0.5), (1, 0.5))  # (label, score) seeds of the running AUC meter
NODE_ROWS = 100_000                # rows of a node of the running AUC that one task orders
# -----------------------------------------------------------------------------


def value_counts(df: DataFrame, col: str) -> DataFrame:                                    # A6
    """Count and share of each non-null value (share of the non-null total)."""
    d = df.where(F.col(col).isNotNull())
    total = d.select(F.count(F.lit(1))).scalar()          # scalar subquery
    return d.groupBy(col).agg(F.count(F.lit(1)).alias("n")).withColumn("share", F.col("n") / total)


def assert_n_distinct(df: DataFrame, col: str, expected: int) -> DataFrame:               # A8
    """One row ``n_classes``; evaluating it raises unless there are ``expected`` values."""
    n = F.countDistinct(col)
    return df.agg(F.when(n == F.lit(expected), n)
                  .otherwise(F.raise_error(F.concat(F.lit(f"expected {expected} distinct values of {col}, got "),
                                                    n.cast("string")))).alias("n_classes"))


def roc_auc(df: DataFrame, label_col: str, score_col: str, part_cols: Sequence[str] = (),
            out="auc") -> DataFrame:                                                        # A10
    part_cols = list(part_cols)
    y = F.col(label_col).cast("long")
    d = df.where(F.col(label_col).isNotNull() & F.col(score_col).isNotNull())
    g = d.groupBy(*part_cols, score_col).agg(F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg"))
    g = with_exclusive_prefix(materialize(g), [score_col], ["neg"], part_cols)
    pos, neg, nb = (F.col(c).cast("double") for c in ("pos", "neg", "neg_before"))
    r = g.groupBy(*part_cols).agg(F.sum(pos * nb + F.lit(0.5) * pos * neg).alias("_num"),
                                  F.sum(pos).alias("_p"), F.sum(neg).alias("_n"))
    return r.select(*part_cols, (F.col("_num") / F.nullif(F.col("_p") * F.col("_n"), F.lit(0.0))).alias(out))


def with_prior_rows(df: DataFrame, label_col: str, score_col: str, part_cols: Sequence[str] = ()) -> DataFrame:   # A11
    """Add the two seed rows of the running AUC meter to every group."""
    part_cols = list(part_cols)
    groups = df.select(*part_cols).distinct() if part_cols else None
    seeds = None
    for y, p in PRIOR_ROWS:
        cols = [F.lit(y).cast(df.schema[label_col].dataType).alias(label_col), F.lit(p).alias(score_col)]
        s = groups.select(*part_cols, *cols) if groups is not None else df.sparkSession.range(1).select(*cols)
        seeds = s if seeds is None else seeds.unionByName(s)
    return df.select(*part_cols, label_col, score_col).unionByName(seeds)


def running_auc(df: DataFrame, label_col: str, score_col: str, batch_col: str, part_cols: Sequence[str] = (),
                prior: bool = True, out: str = "auc", node_rows: int = NODE_ROWS) -> DataFrame:    # A11, one value an update
    """``part_cols, batch_col, n_rows, out``: the AUC of all rows up to and with each batch, as a meter that
    is updated batch by batch reports it. Batches are non-negative numbers; null labels, scores and batches are
    left out. With ``prior`` the two seed rows come before the first batch (and ``n_rows`` does not count them);
    without, batches before the first row of either class have null.

    Pairs are counted in the order (batch, score) by merge counting: two batches part at the highest bit in which
    their numbers differ, so each pair of rows meets in exactly one node of a binary tree over the batches, the
    earlier row on its left and the later one on its right. A row is in ``log2`` of the batches of running sums, all
    in one job: no AUC is computed once a prefix. Nodes of levels without a node beyond ``node_rows`` rows are each
    ordered whole, so nothing is joined back; the few larger nodes of the other levels are cut into score buckets."""
    part_cols = list(part_cols)
    y = F.col(label_col).cast("long")
    d = df.where(F.col(label_col).isNotNull() & F.col(score_col).isNotNull() & F.col(batch_col).isNotNull())
    d = d.select(*part_cols, F.col(score_col).cast("double").alias("_s"), (F.col(batch_col).cast("long") + F.lit(1)).alias("_b"),
                 y.alias("_y"), F.lit(1).cast("long").alias("_real"))
    if prior:
        groups = d.select(*part_cols).distinct() if part_cols else df.sparkSession.range(1)
        seed = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.lit(c).cast("long").alias("c")) for c, p in PRIOR_ROWS])).alias("v")
        d = d.unionByName(groups.select(*part_cols, seed).select(
            *part_cols, F.col("v.p").alias("_s"), F.lit(0).cast("long").alias("_b"), F.col("v.c").alias("_y"), F.lit(0).cast("long").alias("_real")))
    g = materialize(d.groupBy(*part_cols, "_b", "_s").agg(
        F.sum("_y").alias("_pos"), F.sum(F.lit(1) - F.col("_y")).alias("_neg"), F.sum("_real").alias("_n")))
    top = g.select(F.coalesce(F.length(F.bin(F.max("_b"))), F.lit(1)).alias("t")).first()["t"]

    def at_levels(levels):
        # level -1: the rows of one batch among themselves, negatives on the left and positives on the right
        node = F.explode(F.array(*[F.struct(F.lit(v).alias("level"), F.shiftright("_b", v + 1).alias("at"),
                                            F.shiftright("_b", max(v, 0)).bitwiseAND(F.lit(1)).cast("int").alias("right")) for v in levels]))
        e = bucketed.withColumn("_node", node)
        level, right, zero = F.col("_node.level"), F.col("_node.right"), F.lit(0).cast("long")
        return e.select(*part_cols, "_s", "_b", "_bucket", level.alias("_level"), F.col("_node.at").alias("_at"),
                        F.when((level >= 0) & (right == 0), F.col("_pos")).otherwise(zero).alias("_lp"),
                        F.when((level < 0) | (right == 0), F.col("_neg")).otherwise(zero).alias("_ln"),
                        F.when((level < 0) | (right == 1), F.col("_pos")).otherwise(zero).alias("_rp"),
                        F.when((level >= 0) & (right == 1), F.col("_neg")).otherwise(zero).alias("_rn"))
    node, left = [*part_cols, "_level", "_at"], ("_lp", "_ln")

    def sums(e, keys, extra=()):
        """Of the left rows of the same ``keys``: those up to a row's score (``_le``) and of the same score (``_eq``)."""
        upto, same = Window.partitionBy(*keys).orderBy("_s").rangeBetween(Window.unboundedPreceding, Window.currentRow), Window.partitionBy(*keys, "_s")
        return e.select("*", *[F.sum(c).over(upto).alias(f"{c}_le") for c in left], *[F.sum(c).over(same).alias(f"{c}_eq") for c in left], *extra)

    def won(e, le=lambda c: F.col(f"{c}_le")):
        # pairs won with ties counted in full, and without them: their sum is twice the pairs won
        wins = F.col("_rp") * (F.lit(2) * le("_ln") - F.col("_ln_eq")) + F.col("_rn") * (F.lit(2) * (F.col("_lp_total") - le("_lp")) + F.col("_lp_eq"))
        return e.groupBy(*part_cols, "_b").agg(F.sum(wins).alias("_w"))

    bucketed = quantile_bucket(g, "_s")             # buckets of the scores, the same for all nodes
    every = range(-1, top)
    most = {r["_level"]: r["n"] for r in at_levels(every).groupBy(*node).count().groupBy("_level").agg(F.max("count").alias("n")).collect()}   # a row a level
    large = [v for v in every if most.get(v, 0) > node_rows]
    small = [v for v in every if v not in large]
    parts = []
    if small:
        parts.append(won(sums(at_levels(small), node, [F.sum("_lp").over(Window.partitionBy(*node)).alias("_lp_total")])))
    if large:
        e = at_levels(large)
        w_off = Window.partitionBy(*node).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        offs = e.groupBy(*node, "_bucket").agg(*[F.sum(c).alias(f"{c}_bt") for c in left])
        offs = offs.select(*node, "_bucket", *[F.coalesce(F.sum(f"{c}_bt").over(w_off), F.lit(0)).alias(f"{c}_off") for c in left],
                           F.sum("_lp_bt").over(Window.partitionBy(*node)).alias("_lp_total"))
        e = join_table(sums(e, [*node, "_bucket"]), offs, [*node, "_bucket"])
        parts.append(won(e, lambda c: F.col(f"{c}_off") + F.col(f"{c}_le")))
    won_rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    rows = g.groupBy(*part_cols, "_b").agg(F.sum("_pos").alias("_p"), F.sum("_neg").alias("_q"), F.sum("_n").alias("_m"))
    zero = F.lit(0).cast("long")
    t = (won_rows.select(*part_cols, "_b", "_w", zero.alias("_p"), zero.alias("_q"), zero.alias("_m"))
         .unionByName(rows.select(*part_cols, "_b", zero.alias("_w"), "_p", "_q", "_m")))
    t = t.groupBy(*part_cols, "_b").agg(*[F.sum(c).alias(c) for c in ("_w", "_p", "_q", "_m")])
    t = with_exclusive_prefix(materialize(t), ["_b"], ["_w", "_p", "_q", "_m"], part_cols)
    w, p, q, m = (F.col(c) + F.col(f"{c}_before") for c in ("_w", "_p", "_q", "_m"))
    auc = w.cast("double") / F.lit(2.0) / F.nullif(p.cast("double") * q.cast("double"), F.lit(0.0))
    return t.where(F.col("_m") > 0).select(*part_cols, (F.col("_b") - 1).alias(batch_col), m.alias("n_rows"), auc.alias(out))


def threshold_bin(score) -> F.Column:                                                       # A12
    """Index of the highest of the 198 inner thresholds i/199 the score exceeds."""
    k = N_THRESHOLDS - 1
    c = F.col(score) if isinstance(score, str) else score
    return F.least(F.greatest(F.ceil(c * F.lit(float(k))) - F.lit(1), F.lit(0)), F.lit(k - 1)).cast("int")


def accuracy(label_col: str, score_col: str) -> F.Column:                                   # A12
    hit = (F.col(score_col) > F.lit(ACCURACY_CUT)).cast("int") == F.col(label_col).cast("int")
    return F.avg(hit.cast("double"))


def log_loss(label_col: str, score_col: str, smoothing: float = LABEL_SMOOTHING) -> F.Column:   # A14
    p = F.least(F.greatest(F.col(score_col), F.lit(LOGLOSS_EPS)), F.lit(1 - LOGLOSS_EPS))
    t = F.col(label_col).cast("double") * F.lit(1 - smoothing) + F.lit(smoothing / 2)
    return F.avg(-(t * F.log(p) + (F.lit(1.0) - t) * F.log(F.lit(1.0) - p)))
