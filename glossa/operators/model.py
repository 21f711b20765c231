"""Model operators re-aimed as Spark jobs (M1-M3).

* ``train_classifier``: a ``pyspark.ml`` pipeline (HashingTF -> IDF ->
  LogisticRegression) chosen by validation ROC AUC; training stages become
  row weights.
* ``linear_score``: a fixed linear scorer over token ids, evaluated natively
  (``aggregate`` over the id array) -- exact and checkable.
* ``score_in_pandas``: any external scorer, loaded once per partition inside
  ``mapInPandas`` and fed Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.operators.metrics import roc_auc
from glossa.operators.sampling import holdout_split
from glossa.session import materialize

# --- fixed values ------------------------------------------------------------
# linear scorers: weight(id) = (((id * a + b) % 101) - 50) / 1000
LINEAR_SCORERS = {"lin_a": (37, 11), "lin_b": (53, 7)}
HASH_FEATURES = 1 << 18
# -----------------------------------------------------------------------------


def linear_score(ids, name: str) -> Column:                                         # M2 (exact)
    a, b = LINEAR_SCORERS[name]
    c = F.col(ids) if isinstance(ids, str) else ids
    s = F.aggregate(c, F.lit(0.0),
                    lambda acc, x: acc + ((x * F.lit(a) + F.lit(b)) % F.lit(101) - F.lit(50)).cast("double")
                    / F.lit(1000.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-s))


def train_classifier(df: DataFrame, tokens_col: str = "toks", label_col: str = "label",
                     weight_col: str | None = None, reg_params: Sequence[float] = (0.01, 0.1),
                     seed: int = 5353, id_col: str = "id", fraction: float = 0.1) -> tuple[PipelineModel, float]:   # M1
    """The best model and its validation ROC AUC (A10). The validation rows are the seeded hold-out
    (G6), the same under any partitioning; the features are written once and read by every fit."""
    d = materialize(holdout_split(df, id_col, fraction, seed))
    train, valid = (d.where(F.col("split") == x) for x in ("train", "holdout"))
    tf = HashingTF(inputCol=tokens_col, outputCol="_tf", numFeatures=HASH_FEATURES)
    features = Pipeline(stages=[tf, IDF(inputCol="_tf", outputCol="_features")]).fit(train)
    kept = [c for c in (label_col, weight_col) if c]
    fitted, held = (materialize(features.transform(x).select(*kept, "_features")) for x in (train, valid))
    best = None
    for reg in reg_params:
        lr = LogisticRegression(featuresCol="_features", labelCol=label_col, maxIter=30, regParam=reg,
                                **({"weightCol": weight_col} if weight_col else {}))
        lr_model = lr.fit(fitted)
        model = PipelineModel(stages=[*features.stages, lr_model])
        scored = lr_model.transform(held).select(F.col(label_col).alias("y"), vector_to_array("probability")[1].alias("p"))
        auc = roc_auc(scored, "y", "p").first()["auc"]            # one row
        if best is None or (auc or 0.0) > (best[1] or 0.0):
            best = model, auc
    return best


def train_variants(variants: Mapping[str, DataFrame], **options) -> dict[str, tuple[PipelineModel, float]]:   # M1
    """One model and its validation AUC per variant (a fold, a language), each trained on its own rows
    as in ``train_classifier``. Write rows that several variants share before."""
    return {name: train_classifier(rows, **options) for name, rows in variants.items()}


def predict(model: PipelineModel, df: DataFrame, id_col: str = "id", out: str = "toxic") -> DataFrame:   # M2
    p = model.transform(df)
    return p.select(id_col, vector_to_array("probability")[1].alias(out))


def score_in_pandas(df: DataFrame, load: Callable[[], Callable[[pd.DataFrame], pd.Series]],
                    id_col: str = "id", out: str = "toxic") -> DataFrame:                 # M2 (external)
    """``load()`` runs once per partition (e.g. reads model files); the returned
    function scores one Arrow batch."""
    def run(batches: Iterator[pd.DataFrame]):
        fn = load()
        for b in batches:
            yield pd.DataFrame({id_col: b[id_col], out: fn(b).astype("float64")})
    schema = f"{id_col} {df.schema[id_col].dataType.simpleString()}, {out} double"
    return df.mapInPandas(run, schema)
