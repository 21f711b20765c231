"""Operator 13, embedding whitening: FEAST contour integration.

Method:

1. Every usable vector becomes whole numbers x = floor(256 c). The *fit list* holds each distinct
   x once: one grouped aggregation, so copies are merged before they are shuffled. It is a table.
2. Two passes over it sum, inside the tasks and then by entry, first the exact n and S (per
   dimension), then the scatter of x - S/n. Only dimensions x dimensions sums reach the driver.
3. ``feast.top_components`` projects onto the interval of the largest eigenvalues and verifies by
   inertia counts that none is missed. Eigenvectors have either sign, the same for all rows.
4. A third pass over the fit list measures the covariance of the whitened values; the rows of the
   input are projected in one pass without a shuffle.

Defined results: a row is left out if its vector is null, holds null or non-finite entries or
entries whose x does not fit a long, or is not as long as most vectors are (ties: the longer ones).
Components whose eigenvalue is not above 1e-12 of the trace are left out, so vectors of one
dimension give one component and equal vectors give no rows, like an empty table. Repeated rows,
null ids and ids of any type stay as they are; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.llm.feast import top_components
from glossa.llm.storage import stored

SCALE = 256.0
COMPONENTS = 4
_FITS = 9.2e18            # below the largest long


def whole_numbers(vector: Column) -> Column:
    """The vector times 256, rounded down; null if the vector is not usable."""
    scaled = F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(SCALE)))
    ok = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(_FITS / SCALE), F.lit(False))
                  & ~F.coalesce(F.isnan(c.cast("double")), F.lit(True)))
    return F.when(ok, scaled)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("x")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _sums(batches):
    """Exact sums by dimension of all vectors of a task; -1 is their number."""
    total, n = None, 0
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch)
            n += len(x)
            small = np.abs(x.astype(float)).max(initial=0.0) * len(x) < _FITS
            part = [int(v) for v in (x if small else x.astype(object)).sum(axis=0)]
            total = part if total is None else [p + q for p, q in zip(total, part)]
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([-1, *range(len(total))], pa.int32()),
                                          pa.array([str(v) for v in [n, *total]])], names=["i", "s"])


def _scatter(transform):
    """Sums of the products of all pairs of ``transform``ed entries over the vectors of a task."""
    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                y = transform(_matrix(batch))
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])],
                                             names=["i", "j", "s"])
    return run


def _second_moments(fit: DataFrame, transform, size: int, n: int) -> np.ndarray:
    out = np.zeros((size, size))
    for r in (fit.mapInArrow(_scatter(transform), "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
              .collect()):                                     # size * (size + 1) / 2 rows
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["s"] / n
    return out


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: ``id_col, component, n, deviation`` (decimal), ``whitened, explained,
    eigenvalue, identity_error``."""
    spark = vectors.sparkSession
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = (f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, "
              "eigenvalue double, identity_error double")
    rows = vectors.select(F.col(id_col).alias("id"), whole_numbers(F.col(vector_col)).alias("x")).where("x is not null")
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("k"))
    most = lengths.agg(F.max_by("d", F.struct("k", "d")).alias("d")).first()["d"]
    rows = rows.where(F.size("x") == F.lit(most if most is not None else -1))
    fit = stored(rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies")), "fit").select("x")
    sums = {r["i"]: int(r["s"]) for r in fit.mapInArrow(_sums, "i int, s string").groupBy("i")
            .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()}    # dimensions + 1 rows
    n = sums.pop(-1, 0)
    total = [sums[i] for i in range(len(sums))]
    mean = np.array([s / n for s in total])
    cov = _second_moments(fit, lambda x: x - mean, len(total), n)
    values, axes = top_components(cov, components)
    if not len(values):
        return spark.createDataFrame([], schema.replace("id ", f"`{id_col}` ", 1))
    scale = np.sqrt(values)
    trace = float(np.trace(cov))

    def project(x):
        return (x - mean) @ axes.T / scale
    moments = _second_moments(fit, project, len(values), n)                        # whitened values have mean zero
    error = float(np.abs(moments - np.eye(len(values))).max())
    k = len(values)
    largest = max(map(abs, total), default=0)

    def out(batches):
        from decimal import Decimal
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                batch = whole.slice(start, 4096)
                x = _matrix(batch)
                m = len(x)
                wide = np.abs(x.astype(float)).max(initial=0.0) * n + largest
                exact = x.astype(object) if wide * wide * x.shape[1] >= _FITS else x
                deviation = ((exact * n - np.array(total, dtype=exact.dtype)) ** 2).sum(axis=1)
                deviation = pa.array([Decimal(int(v)) for v in deviation], pa.decimal128(38, 0))
                take = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(take)), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                     pa.array(np.full(m * k, n), pa.int64()), deviation.take(pa.array(take)), pa.array(project(x).ravel()),
                     pa.array(np.tile(values / trace, m)), pa.array(np.tile(values, m)), pa.array(np.full(m * k, error))],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "eigenvalue", "identity_error"])
    return rows.mapInArrow(out, schema).withColumnRenamed("id", id_col)


def digest(result: DataFrame) -> DataFrame:
    """The columns of the query; a deviation beyond a long is null."""
    return result.select("vec_id", "component", "n", F.expr("try_cast(deviation as bigint)").alias("deviation"), "whitened",
                         "explained", "identity_error")
