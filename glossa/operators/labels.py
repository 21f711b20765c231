"""Label preparation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values ------------------------------------------------------------
# (min_thresh, max_thresh, class_ratio) of the staged training runs
BASE_STAGE = (0.2, 0.7, 2)
FOLD_STAGE = (0.3, 0.6, 3)
SUBTYPES_2018 = ("severe_toxic", "obscene", "threat", "insult", "identity_hate")
SUBTYPES_2019 = ("severe_toxicity", "obscene", "threat", "insult", "identity_attack")
# -----------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def band_filter(df: DataFrame, col: str, min_thresh: float, max_thresh: float) -> DataFrame:   # P9
    """Drop the ambiguous band: keep ``x < min_thresh OR x >= max_thresh``."""
    return df.where((F.col(col) < F.lit(min_thresh)) | (F.col(col) >= F.lit(max_thresh)))


def binarise(c, max_thresh: float) -> Column:                                                # P13
    return F.when(_c(c) >= F.lit(max_thresh), F.lit(1)).otherwise(F.lit(0))


def round_label(c) -> Column:                                                                 # P13
    """``Series.round().astype(int)``: half to even."""
    return F.bround(_c(c), 0).cast("int")


def round1(c) -> Column:                                                                      # P15
    """``Series.round(1)``: half to even on ``x * 10``."""
    return F.rint(_c(c) * F.lit(10.0)) / F.lit(10.0)


def label_max(toxic, subtypes: Sequence) -> Column:                                           # P14
    """``np.maximum(toxic, row-max(subtypes))``: the row max skips nulls, the
    outer maximum propagates them."""
    cols = [_c(s) for s in subtypes]
    inner = F.greatest(*cols) if len(cols) > 1 else cols[0]
    t = _c(toxic)
    return F.when(t.isNotNull() & inner.isNotNull(), F.greatest(t, inner))


def training_labels(raw: DataFrame, subtypes: Sequence[str], round_first: bool,
                    lang: str = "en") -> DataFrame:                                           # E12 (one table)
    d = raw
    if round_first:
        for c in ["toxic", *subtypes]:
            d = d.withColumn(c, round1(c))
    return d.select("id", F.lit(lang).alias("lang"), "comment_text",
                    label_max("toxic", subtypes).alias("toxic_float"))


def transfer_labels(foreign: DataFrame, english: DataFrame, label_col="toxic_float") -> DataFrame:   # E11 / J2
    """Left join of translations with English labels by string id, unmatched dropped."""
    lab = english.select(F.col("id").cast("string").alias("id"), label_col)
    f = foreign.withColumn("id", F.col("id").cast("string"))
    return f.join(lab, "id", "left").where(F.col(label_col).isNotNull())


def pseudo_label(unlabeled: DataFrame, scores: DataFrame, score_col="toxic") -> DataFrame:   # E10
    """Join scores onto unlabeled rows; ``toxic_float = round(score, 1)``."""
    j = unlabeled.join(scores.select("id", score_col), "id", "inner")
    return j.withColumn("toxic_float", round1(score_col)).drop(score_col)
