"""Staged training of many model variants by one gradient job (M1).

A variant is a logistic model over hashed tokens trained on some of the rows (a fold, a language).
All variants are fitted together: each job reads the feature table once and sums, inside the tasks,
the gradients of every variant at its current point; the driver, which holds one weight vector a
variant, takes a quasi-Newton step for each. Stages run one after another on their own rows; each starts
from the weights of the one before and is pulled toward them. The weights of the stage with the best
validation ROC AUC (A10) stay. Work grows with the rows, not with rows times jobs a variant.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.operators.metrics import roc_auc
from glossa.session import materialize

FEATURES = 1 << 12          # hashed token features; weights of a variant on the driver
STEPS = 10                  # gradient jobs of a stage
MEMORY = 5                  # remembered steps of the quasi-Newton update
_ROWS = 400                 # texts scored at once in a task


def feature_table(df: DataFrame, keep: Sequence[str], tokens_col: str, train: Mapping[str, Column], stages: Mapping[str, Column],
                  score: Mapping[str, Column] | None = None, features: int = FEATURES) -> DataFrame:
    """``keep``, hashed tokens ``x`` and the bits of the variants a row trains, of the stages it belongs to and of the
    variants that score it (default: all), written once. Conditions that are null do not hold."""
    def bits(conditions):
        return sum((F.when(c, F.lit(1 << k)).otherwise(F.lit(0)) for k, c in enumerate(conditions)), F.lit(0)).cast("long")
    x = F.transform(tokens_col, lambda t: F.pmod(F.xxhash64(t), F.lit(features)).cast("int"))
    return materialize(df.select(*keep, F.coalesce(x, F.array().cast("array<int>")).alias("x"), bits(train.values()).alias("train"),
                                 bits(stages.values()).alias("stages"), bits((score or train).values()).alias("score")))


def _margins(batch: pa.RecordBatch, start: int, weights: np.ndarray):
    """Features, the row and the value of each, and the margins (rows x variants) of some rows of a batch.
    Counts are damped by the square root of the text's length; the last weight is the intercept."""
    part = batch.slice(start, _ROWS)
    column = part.column("x")
    idx = column.flatten().to_numpy()
    n = np.diff(column.offsets.to_numpy())
    row = np.repeat(np.arange(len(n)), n)
    value = 1 / np.sqrt(np.maximum(n, 1))[row]
    margin = np.empty((len(n), len(weights)))
    for v, w in enumerate(weights):
        margin[:, v] = np.bincount(row, weights=w[idx] * value, minlength=len(n)) + w[-1]
    return part, idx, row, value, margin


def _members(bits: np.ndarray, variants: int) -> np.ndarray:
    return (bits[:, None] >> np.arange(variants) & 1).astype(float)


def _gradient(weights: np.ndarray, stage: int):
    """Sums over the rows of a task: gradients by variant and feature; -1 is the loss, -2 the weight of the rows."""
    variants, size = weights.shape

    def run(batches):
        total = np.zeros((variants, size))
        loss, mass = np.zeros(variants), np.zeros(variants)
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part, idx, row, value, margin = _margins(batch, start, weights)
                y = part.column("label").to_numpy(zero_copy_only=False)[:, None]
                use = part.column("w").to_numpy(zero_copy_only=False)[:, None] * _members(part.column("train").to_numpy(), variants)
                use = use * (part.column("stages").to_numpy() >> stage & 1)[:, None]
                loss += (use * (np.logaddexp(0, margin) - y * margin)).sum(axis=0)
                mass += use.sum(axis=0)
                residual = use * (1 / (1 + np.exp(-margin)) - y)
                for v in range(variants):
                    total[v, :-1] += np.bincount(idx, weights=residual[row, v] * value, minlength=size - 1)
                total[:, -1] += residual.sum(axis=0)
        v, i = np.nonzero(total)
        every = np.arange(variants)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate((v, every, every)), pa.int32()),
             pa.array(np.concatenate((i, np.full(variants, -1), np.full(variants, -2))), pa.int32()),
             pa.array(np.concatenate((total[v, i], loss, mass)))], names=["v", "i", "g"])
    return run


def _evaluate(rows: DataFrame, weights: np.ndarray, stage: int):
    """Mean loss and gradient of every variant: one job, at most variants x (features + 3) rows to the driver."""
    got = (rows.mapInArrow(_gradient(weights, stage), "v int, i int, g double").groupBy("v", "i").agg(F.sum("g").alias("g"))
           .toPandas())
    v, i, g = got["v"].to_numpy(int), got["i"].to_numpy(int), got["g"].to_numpy()
    gradient, loss, mass = np.zeros_like(weights), np.zeros(len(weights)), np.zeros(len(weights))
    gradient[v[i >= 0], i[i >= 0]] = g[i >= 0]
    loss[v[i == -1]] = g[i == -1]
    mass[v[i == -2]] = g[i == -2]
    mass = np.maximum(mass, 1e-12)
    return loss / mass, gradient / mass[:, None]


@dataclass
class _Descent:
    """Limited-memory quasi-Newton descent of one variant: ``point`` is to be evaluated next."""
    best: np.ndarray
    point: np.ndarray = None
    value: float = np.inf
    gradient: np.ndarray = None
    direction: np.ndarray = None
    step: float = 1.0
    pairs: list = field(default_factory=list)

    def __post_init__(self):
        self.point = self.best

    def told(self, value: float, gradient: np.ndarray) -> None:
        if value <= self.value:
            if self.gradient is not None:
                s, y = self.point - self.best, gradient - self.gradient
                if s @ y > 1e-12:
                    self.pairs = [*self.pairs, (s, y)][-MEMORY:]
            self.best, self.value, self.gradient, self.step = self.point, value, gradient, 1.0
            self.direction = -self._preconditioned(gradient)
        else:
            self.step /= 4
        self.point = self.best + self.step * self.direction

    def _preconditioned(self, g: np.ndarray) -> np.ndarray:
        g, used = g.copy(), []
        for s, y in reversed(self.pairs):
            a = s @ g / (s @ y)
            g -= a * y
            used.append(a)
        if self.pairs:
            s, y = self.pairs[-1]
            g *= s @ y / (y @ y)
        for (s, y), a in zip(self.pairs, reversed(used)):
            g += s * (a - y @ g / (s @ y))
        return g


def fit_stage(rows: DataFrame, weights: np.ndarray, stage: int, ridge: float, steps: int = STEPS) -> np.ndarray:
    """Weights (variants x features + 1) after a stage that starts from ``weights`` and is pulled toward them."""
    descents = [_Descent(w) for w in weights]
    for _ in range(steps):
        at = np.array([d.point for d in descents])
        loss, gradient = _evaluate(rows, at, stage)
        away = at - weights
        away[:, -1] = 0                                       # the intercept is free
        loss = loss + ridge / 2 * (away ** 2).sum(axis=1)
        gradient = gradient + ridge * away
        for d, value, g in zip(descents, loss, gradient):
            d.told(value, g)
    return np.array([d.best for d in descents])


def scores(table: DataFrame, keep: Sequence[str], weights: np.ndarray, names: Sequence[str], bits: str = "score") -> DataFrame:
    """``keep, variant, toxic``: the score of every row by every variant whose bit is set in ``bits``."""
    kinds = {c: table.schema[c].dataType.simpleString() for c in keep}

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part, *_, margin = _margins(batch, start, weights)
                row, v = np.nonzero(_members(part.column(bits).to_numpy(), len(weights)))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(pa.array(row)) for c in keep), pa.array(np.array(names, object)[v], pa.string()),
                     pa.array(1 / (1 + np.exp(-margin[row, v])))], names=[*keep, "variant", "toxic"])
    return table.select(*keep, "x", bits).mapInArrow(run, ", ".join(f"{c} {k}" for c, k in kinds.items()) + ", variant string, toxic double")


def train_staged(table: DataFrame, names: Sequence[str], stages: int, holdout_col: str = "holdout", ridge: float = 1e-3,
                 steps: int = STEPS) -> tuple[np.ndarray, dict[str, float]]:
    """``(weights, auc)``: for each variant the weights of its best stage and their AUC on the held-out rows it would train on.

    ``table`` is a ``feature_table`` with ``label`` (0 or 1), ``w`` and a boolean ``holdout_col``; rows without a label train
    nothing. A stage of which a variant has no rows changes nothing; without both labels in the hold-out its AUC is None and
    the last stage stays."""
    size = int(FEATURES) + 1
    rows = table.where(F.col("label").isNotNull() & ~F.col(holdout_col)).select("label", "w", "x", "train", "stages")
    valid = table.where(F.col("label").isNotNull() & F.col(holdout_col))
    weights = np.zeros((len(names), size))
    best, best_auc = weights, {}
    for stage in range(stages):
        weights = fit_stage(rows, weights, stage, ridge, steps)
        scored = scores(valid, ["label"], weights, names, "train")
        auc = {r["variant"]: r["auc"] for r in roc_auc(scored, "label", "toxic", ["variant"]).collect()}      # one row a variant
        take = np.array([stage == 0 or auc.get(n) is None or best_auc.get(n) is None or auc[n] > best_auc[n] for n in names])
        best = np.where(take[:, None], weights, best)
        best_auc |= {n: auc.get(n) for n, t in zip(names, take) if t}
    return best, best_auc
