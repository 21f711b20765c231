"""Score roll-ups and blends.

Scores live in one *long* table ``(id, name, score)``. An N-way inner join on
``id`` is one conditional aggregation (one shuffle on ``id``, map-side
partial aggregation) instead of N-1 joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.functions import text as T
from glossa.operators.scale import join_table, pct_rank
from glossa.session import materialize

# --- fixed values ------------------------------------------------------------
CALIBRATION_MEAN = 0.21                      # calibrated files have this mean
TTA_WEIGHTS = {"no_tta": (1.0, 0.0), "tta": (5.0, 1.0)}   # (original row, other view)
FOLD_WEIGHTS = (0.8, 0.2, 0.5)               # foreign, rest, english share of rest
FAMILY_WEIGHTS = (("roberta", 9.0), ("xlm", 2.0), ("bert", 1.0))   # sum 12
FINAL_WEIGHTS = (("single_roberta", 0.08), ("mlm", 0.29), ("mono", 0.44), ("mas", 0.19))
# language -> (base weight, [(model, weight), ...]); other languages keep base
LANG_ROUTES = {"tr": (0.1, (("tr_1", 0.45), ("tr_2", 0.45))),
               "it": (0.1, (("it_1", 0.9),)),
               "es": (0.1, (("es_1", 0.45), ("es_2", 0.45))),
               "ru": (0.1, (("ru_1", 0.45), ("ru_2", 0.45))),
               "fr": (0.1, (("fr_1", 0.45), ("fr_2", 0.45)))}
IP_RULE_LANGS = ("es", "tr")
IP_RULE_BAND = (0.5, 0.9)                    # open interval
IP_RULE_FACTOR = 1.1
BOT_FACTOR = 0.5
CLUSTER_FACTOR = 0.5
TEMPLATE_CLUSTERS = (39, 52, 100, 14, 111, 80, 42, 196)
# -----------------------------------------------------------------------------


def doc_max(df: DataFrame, id_col="id", score_col="toxic", out="toxic") -> DataFrame:      # A1
    return df.groupBy(id_col).agg(F.max(score_col).alias(out))


def doc_mean(df: DataFrame, id_col="id", score_col="toxic", out="toxic") -> DataFrame:     # A2 / A3
    return df.groupBy(id_col).agg(F.avg(score_col).alias(out))


def weighted_mean(df: DataFrame, keys: Sequence[str], value: Column, weight: Column,
                  out="toxic") -> DataFrame:                                                 # A4 / A13
    """``sum(v*w) / sum(w)`` per key; zero total weight gives null."""
    g = df.groupBy(*keys).agg(F.sum(value * weight).alias("_vw"), F.sum(weight).alias("_w"))
    return g.select(*keys, (F.col("_vw") / F.nullif(F.col("_w"), F.lit(0.0))).alias(out))


def calibrate(df: DataFrame, score_col: str, by: Sequence[str] = (), target=CALIBRATION_MEAN) -> DataFrame:   # A5
    """``x / mean(x) * target`` per group ``by`` (whole table when empty)."""
    by = list(by)
    if by:
        means = df.groupBy(*by).agg(F.avg(score_col).alias("_mean"))
        d = join_table(df, means, by)
        return d.withColumn(score_col, F.col(score_col) / F.col("_mean") * F.lit(target)).drop("_mean")
    mean = df.select(F.avg(score_col)).scalar()    # scalar subquery, planned once
    return df.withColumn(score_col, F.col(score_col) / mean * F.lit(target))


def wide_inner(long_df: DataFrame, id_col: str, name_col: str, value_col: str,
               names: Sequence[str], rename: Mapping[str, str] | None = None,
               carry: Sequence[str] = ()) -> DataFrame:                                        # J4
    """N-way inner join of per-name score files on ``id``: one row per id present
    in every file, a column per name (``carry`` columns: their non-null max). A file with two
    rows for an id is an error."""
    rename = dict(rename or {})
    g = long_df.groupBy(id_col).agg(*[F.max(c).alias(c) for c in carry], *_pivot(name_col, value_col, names))
    present = reduce(lambda a, b: a & b, [F.col(f"_has_{n}").isNotNull() for n in names])
    return g.where(present).select(id_col, *carry, *[_single(id_col, n).alias(rename.get(n, n)) for n in names])


def _pivot(name_col: str, value_col: str, names: Sequence[str]) -> list[Column]:
    """The value of each name and how many rows have it (null: none), as aggregates."""
    hits = {n: F.col(name_col) == F.lit(n) for n in names}
    return ([F.max(F.when(hit, F.col(value_col))).alias(f"_at_{n}") for n, hit in hits.items()]
            + [F.sum(F.when(hit, F.lit(1))).alias(f"_has_{n}") for n, hit in hits.items()])


def _single(id_col: str, name: str) -> Column:
    """The value of ``name``; raises where an id has several rows of it."""
    twice = F.raise_error(F.concat(F.lit(f"several rows of {name} for one id: "), F.col(id_col).cast("string")))
    return F.when(F.col(f"_has_{name}") > 1, twice.cast("double")).otherwise(F.col(f"_at_{name}"))


def wide_left(base: DataFrame, long_df: DataFrame, id_col: str, name_col: str, value_col: str,
              names: Sequence[str]) -> DataFrame:                                            # J3
    """Left-join enrichment of ``base`` with one column per score file. A file with two rows for an
    id is an error."""
    wide = long_df.groupBy(id_col).agg(*_pivot(name_col, value_col, names))
    return base.join(wide.select(id_col, *[_single(id_col, n).alias(n) for n in names]), on=id_col, how="left")


def fold_key(view: str, fold: int) -> str:
    return view if fold < 0 else f"{view}_{fold}"


def _power_mean(family: str, folds: Sequence[int], extra_fold: Mapping[int, int], views: int) -> tuple[list[str], Column]:
    """The series that a family's blend needs, and the blend over columns of these names."""
    wf, wr, we = FOLD_WEIGHTS

    def series(view, fold):
        return f"{family}_{fold_key(view, fold)}"
    english = series("english", -1)
    names, roots = [english], []
    for f in folds:
        foreign, rest = series("foreign", f), F.col(english)
        names.append(foreign)
        if views == 3:
            extra = series("extra", extra_fold.get(f, f))
            names.append(extra)
            rest = F.lit(we) * rest + F.lit(1 - we) * F.col(extra)
        roots.append(F.sqrt(F.lit(wf) * F.col(foreign) + F.lit(wr) * rest))
    mean = reduce(lambda a, b: a + b, roots) / F.lit(float(len(folds)))
    return sorted(set(names)), mean * mean


def power_mean_blends(fold_scores: DataFrame, specs: Mapping[str, tuple], incomplete: bool = False) -> DataFrame:   # E1 / E2
    """``id`` and one blend per family of ``specs`` (family -> folds, extra-fold map, views): per
    fold ``m = .8 foreign + .2 (.5 english + .5 extra)`` (or ``.8 foreign + .2 english`` with two
    views); the blend is ``(mean_f sqrt(m_f))^2``. All series of all families come out of one
    conditional aggregation; ids that miss one of them drop, or with ``incomplete`` have a null
    blend in the families concerned."""
    blends = {fam: _power_mean(fam, folds, dict(extra or {}), views) for fam, (folds, extra, views) in specs.items()}
    long = fold_scores.where(F.col("family").isin(*specs)).select(
        "id", F.concat_ws("_", "family", "view", F.when(F.col("fold") >= 0, F.col("fold").cast("string"))).alias("k"),
        "toxic")
    names = [n for names, _ in blends.values() for n in names]
    if incomplete:
        w = long.groupBy("id").agg(*[F.max(F.when(F.col("k") == n, F.col("toxic"))).alias(n) for n in names])
    else:
        w = wide_inner(long, "id", "k", "toxic", names)
    return w.select("id", *[blend.alias(fam) for fam, (_, blend) in blends.items()])


def power_mean_blend(fold_scores: DataFrame, family: str, folds: Sequence[int],
                     extra_fold: Mapping[int, int] | None = None, views: int = 3,
                     out="toxic") -> DataFrame:                                              # E1 / E2
    """``power_mean_blends`` of one family."""
    return power_mean_blends(fold_scores, {family: (folds, extra_fold, views)}).withColumnRenamed(family, out)


def family_blend(fams: DataFrame, out="toxic") -> Column:                                    # E3
    """``(9 roberta + 2 xlm + 1 bert) / 12`` over columns named by family."""
    num = reduce(lambda a, b: a + b, [F.lit(w) * F.col(n) for n, w in FAMILY_WEIGHTS])
    return (num / F.lit(sum(w for _, w in FAMILY_WEIGHTS))).alias(out)


def rank_long(long_df: DataFrame, name_col: str, value_col: str, out: str) -> DataFrame:   # W1 xN
    """W1 of every named score series of a long ``(id, name, value)`` table in
    one pass: one value-count table (partitioned by name), one checkpoint, one
    prefix-sum plan -- instead of one of each per series."""
    return pct_rank(long_df, value_col, out, part_cols=[name_col])


def rank_columns(df: DataFrame, cols: Sequence[str], id_col="id", suffix="_rank") -> DataFrame:   # W1 xN
    """``id`` plus the W1 rank of each of ``cols`` (null where the value is null)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("_name"), F.col(c).cast("double").alias("_v")) for c in cols])
    long = df.select(id_col, F.explode(pairs).alias("_p")).select(id_col, "_p._name", "_p._v")
    r = rank_long(long, "_name", "_v", "_r")
    return r.groupBy(id_col).agg(*[F.max(F.when(F.col("_name") == c, F.col("_r"))).alias(c + suffix) for c in cols])


def lang_routed(base: DataFrame, lang_scores: DataFrame, base_col="toxic", out="pred",
                routes=LANG_ROUTES) -> DataFrame:                                            # E6
    models = [m for _, (_, ms) in routes.items() for m, _ in ms]
    d = wide_left(base, lang_scores, "id", "model", "toxic", models)
    expr = None
    for lang, (wb, ms) in routes.items():
        v = F.lit(wb) * F.col(base_col)
        for m, wm in ms:
            v = v + F.lit(wm) * F.col(m)
        expr = F.when(F.col("lang") == lang, v) if expr is None else expr.when(F.col("lang") == lang, v)
    return d.withColumn(out, expr.otherwise(F.col(base_col))).drop(*models)


RAW_INPUTS = ("mas",)       # already a rank blend (E4): enters the final blend as it is


def final_rank_blend(scores: Mapping[str, DataFrame], out="blend", carry: Sequence[str] = ("lang",)) -> DataFrame:   # E7
    """Rank each input ``(id, value[, carry])`` over its own ids (W1) unless it is in
    ``RAW_INPUTS``, inner-join them on id and weight by FINAL_WEIGHTS. The inputs are stacked into one long
    table, so the four ranks share one pass and the four-way join is one
    conditional aggregation on id."""
    names = [n for n, _ in FINAL_WEIGHTS]
    parts = []
    for n in names:
        d = scores[n]
        extra = [F.col(c) if c in d.columns else F.lit(None).cast("string").alias(c) for c in carry]
        parts.append(d.select("id", F.lit(n).alias("_name"), F.col("value").cast("double").alias("_v"), *extra))
    long = reduce(lambda a, b: a.unionByName(b), parts)
    raw = F.col("_name").isin(*RAW_INPUTS)
    ranked = rank_long(long.where(~raw), "_name", "_v", "_r").unionByName(
        long.where(raw).withColumn("_r", F.col("_v")), allowMissingColumns=True)
    w = wide_inner(ranked, "id", "_name", "_r", names, carry=carry)
    expr = reduce(lambda a, b: a + b, [F.lit(wt) * F.col(n) for n, wt in FINAL_WEIGHTS])
    return w.withColumn(out, expr)


def post_process(blend: DataFrame, texts: DataFrame, clusters: DataFrame,
                 text_col="comment_text") -> DataFrame:                                      # E9
    """Rule cascade. Rule 1 tests the raw blend, rules 2 and 3 scale the running
    value; ids without a text or cluster row drop (inner joins)."""
    flags = texts.select("id", T.has_ipv4(text_col).alias("has_ip"),
                         T.is_template_message(text_col).alias("is_bot_msg"))
    d = blend.join(flags, "id", "inner").join(clusters.select("id", "cluster"), "id", "inner")
    lo, hi = IP_RULE_BAND
    r1 = F.when((F.col("has_ip") == 1) & F.col("lang").isin(*IP_RULE_LANGS)
                & (F.col("blend") > lo) & (F.col("blend") < hi),
                F.lit(IP_RULE_FACTOR) * F.col("blend")).otherwise(F.col("blend"))
    d = d.withColumn("pp_ip", r1)
    d = d.withColumn("pp_bot", F.when(F.col("is_bot_msg"), F.lit(BOT_FACTOR) * F.col("pp_ip"))
                     .otherwise(F.col("pp_ip")))
    d = d.withColumn("blend_pp", F.when(F.col("cluster").isin(*TEMPLATE_CLUSTERS),
                                        F.lit(CLUSTER_FACTOR) * F.col("pp_bot"))
                     .otherwise(F.col("pp_bot")))
    return d


def tta_rollups(df: DataFrame, variants: Sequence[str] = tuple(TTA_WEIGHTS), file_col: str | None = None, id_col="id",
                score_col="score", original_col="original") -> DataFrame:                    # E8
    """Calibrate each file, weight views by ``original`` (no-TTA 1/0, TTA 5/1), weighted mean per
    id, calibrate again. ``id`` and one column per variant, all from one aggregation, which is
    written once: the means of the second calibration read it too."""
    d = df.select(*([file_col] if file_col else []), id_col, original_col, F.col(score_col).alias("toxic"))
    d = calibrate(d, "toxic", by=[file_col] if file_col else [])
    sums = []
    for v in variants:
        w_orig, w_other = TTA_WEIGHTS[v]
        w = F.when(F.col(original_col) == 1, F.lit(w_orig)).otherwise(F.lit(w_other))
        sums.append((F.sum(F.col("toxic") * w) / F.nullif(F.sum(w), F.lit(0.0))).alias(v))
    r = materialize(d.groupBy(id_col).agg(*sums))
    for v in variants:
        r = calibrate(r, v)
    return r


def tta_rollup(df: DataFrame, variant: str, file_col: str | None = None, id_col="id",
               score_col="score", original_col="original") -> DataFrame:                     # E8
    """``tta_rollups`` of one variant, as column ``toxic``."""
    return tta_rollups(df, [variant], file_col, id_col, score_col, original_col).withColumnRenamed(variant, "toxic")
