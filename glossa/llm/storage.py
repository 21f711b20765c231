"""Intermediate tables in the shared folder, and joins with a side of checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.session import scratch_path

BROADCAST_ROWS = 10_000     # a table of at most this many narrow rows may be broadcast


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: it is computed once,
    and a lost executor costs no more than re-reading a file. Compressed, unlike a checkpoint."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_small(df: DataFrame, table: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join with a table that is normally tiny (one row per source, site, ...): broadcast
    when it has at most ``BROADCAST_ROWS`` rows, otherwise an ordinary shuffle join, whose
    hot keys adaptive execution splits. ``table`` should be stored already."""
    small = table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return df.join(F.broadcast(table) if small else table, keys, how)


