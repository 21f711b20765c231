"""Operator 10, sharding: a uniform shuffle into shards of exact size.

Method: a hypergeometric communication matrix. Rows fall into logical source partitions by a
hash. For each partition the number of rows it sends to each shard is drawn exactly
(multivariate hypergeometric, given the room left in the shards), so the matrix has the
partition sizes as row sums and the shard sizes as column sums. Rows are permuted inside
their partition, dealt out by the matrix, and permuted again inside their shard.

Law ``rows``: shard sizes differ by at most one. The driver holds one number per partition
and shard (partitions have about ``PARTITION_ROWS`` rows). No task holds a whole shard:
the second permutation is a hashed bucket, an offset per bucket and a place in it. Places
follow 64-bit hashes of a row's identity and its number among equal rows, so no text is
carried twice and copies of a row move as independently as other rows. More than
``HOT_ROWS`` equal rows are salted before they are numbered.

Defined results: rows without id take part like others; equal rows are interchangeable; an
empty table gives no rows; input columns named ``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossa.llm.storage import join_small, stored

SEED = 97
N_SHARDS = 8
PARTITION_ROWS = 500_000
MIN_PARTITIONS = 64
HOT_ROWS = 10_000          # equal rows that one task numbers


def draw_hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Number of good items among ``n`` drawn without replacement. Inverts the distribution over
    14 standard deviations around its mode (less is left out than a double resolves)."""
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    total = good + bad
    mode = min(high, max(low, (n + 1) * (good + 1) // (total + 2)))
    sd = math.sqrt(max(1e-9, n * (good / total) * (bad / total) * ((total - n) / max(1, total - 1))))
    reach = int(14 * sd) + 20
    a, b = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(a, b, dtype=np.float64)
    ratio = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1)     # p(k + 1) / p(k)
    log_p = np.concatenate(([0.0], np.cumsum(ratio)))
    p = np.exp(log_p - log_p[mode - a])
    c = np.cumsum(p)
    return a + int(np.searchsorted(c, rng.random() * c[-1], "right"))


def communication_matrix(sizes: list[int], n_shards: int, seed: int) -> np.ndarray:
    """Rows that each partition sends to each shard; shard sizes differ by at most one."""
    total = sum(sizes)
    room = [total // n_shards + (j < total % n_shards) for j in range(n_shards)]
    rng = np.random.default_rng(seed)
    out = np.zeros((len(sizes), n_shards), np.int64)
    for i, size in enumerate(sizes):
        left, rest = size, sum(room)
        for j in range(n_shards):
            rest -= room[j]
            out[i, j] = draw_hypergeometric(rng, room[j], rest, left) if left else 0
            left -= int(out[i, j])
            room[j] -= int(out[i, j])
    return out


def shard(docs: DataFrame, identity: list[str], n_shards: int = N_SHARDS, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` with ``shard`` and ``slot`` (0, 1, ... inside each shard). ``identity``
    names columns that tell rows apart: rows equal in all of them are interchangeable."""
    spark = docs.sparkSession
    total = docs.count()
    n_parts = max(MIN_PARTITIONS, math.ceil(total / PARTITION_ROWS))
    d = _apart(docs.select(F.struct(*docs.columns).alias("_r"), F.xxhash64(F.lit(f"{seed}/row"), *identity).alias("_k")), n_parts, seed)
    d = d.withColumn("_p", F.pmod(F.xxhash64(F.lit(f"{seed}/partition"), "_k", "_n"), F.lit(n_parts)).cast("int"))
    sizes = dict(d.groupBy("_p").count().collect())                       # one number per partition
    parts = sorted(sizes)
    matrix = communication_matrix([sizes[p] for p in parts], n_shards, seed)
    upto = spark.createDataFrame([(p, [int(x) for x in np.cumsum(row)]) for p, row in zip(parts, matrix)],
                                 "_p int, _upto array<long>")
    equal = F.row_number().over(Window.partitionBy("_p", "_k", "_n").orderBy("_k"))
    d = d.repartition("_p").withColumn("_copy", equal)                     # one exchange for both windows
    row_hash = [F.xxhash64(F.lit(f"{seed}/{use}"), "_k", "_n", "_copy") for use in ("first", "bucket", "second", "tie")]
    d = d.select("_r", "_p", *[h.alias(f"_h{i}") for i, h in enumerate(row_hash, 1)])
    d = d.withColumn("_place", F.row_number().over(Window.partitionBy("_p").orderBy("_h1", "_h4")))
    d = d.join(F.broadcast(upto), "_p")                                   # n_parts rows
    d = d.withColumn("_shard", F.size(F.filter("_upto", lambda x: x < F.col("_place"))))
    d = d.withColumn("_bucket", F.pmod("_h2", F.lit(n_parts)).cast("int"))
    d = stored(d.select("_r", "_h3", "_h4", "_shard", "_bucket"), "sharded")
    counts = sorted(tuple(r) for r in d.groupBy("_shard", "_bucket").count().collect())    # n_shards * n_parts numbers
    offsets, last, done = [], None, 0
    for s, b, n in counts:
        done = 0 if s != last else done
        offsets.append((s, b, done))
        last, done = s, done + n
    offsets = spark.createDataFrame(offsets, "_shard int, _bucket int, _before long")
    d = d.withColumn("_place", F.row_number().over(Window.partitionBy("_shard", "_bucket").orderBy("_h3", "_h4")))
    d = d.join(F.broadcast(offsets), ["_shard", "_bucket"])               # n_shards * n_parts rows
    own = {"shard": F.col("_shard"), "slot": (F.col("_before") + F.col("_place") - 1).cast("long")}
    return d.select(*[F.col("_r")[c].alias(c) for c in docs.columns if c not in own], *[x.alias(k) for k, x in own.items()])


def _apart(d: DataFrame, n_salts: int, seed: int) -> DataFrame:
    """``d`` (rows ``_r`` with the hash ``_k`` of their identity) with ``_n``: 0, or the number of a row among
    more than ``HOT_ROWS`` equal ones. Salts follow no content, so they are stored before they are used."""
    hot = stored(d.groupBy("_k").count().where(F.col("count") > HOT_ROWS).select("_k", F.lit(True).alias("_hot")), "hot")
    if hot.isEmpty():
        return d.withColumn("_n", F.lit(0).cast("long"))
    salt = F.when(F.col("_hot"), F.floor(F.rand(seed) * n_salts).cast("int")).otherwise(0)
    d = stored(join_small(d, hot, ["_k"]).withColumn("_salt", salt), "salted")
    upto = Window.partitionBy("_k").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)     # n_salts rows at most
    ahead = d.where("_hot").groupBy("_k", "_salt").count().select("_k", "_salt", F.sum("count").over(upto).alias("_ahead"))
    d = d.withColumn("_n", F.row_number().over(Window.partitionBy("_k", "_salt").orderBy("_k")))
    d = join_small(d, stored(ahead, "ahead"), ["_k", "_salt"])
    number = F.coalesce("_ahead", F.lit(0)) + F.col("_n")
    return d.select("_r", "_k", F.when(F.col("_hot"), number).otherwise(0).cast("long").alias("_n"))


def with_digest(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32`` of each document, taken before the rows move."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))


def digest(result: DataFrame) -> DataFrame:
    """The columns of the query."""
    none: Column = F.lit(None).cast("int")
    return result.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", none.alias("grown_shard"))
