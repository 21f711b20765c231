"""A filter of fixed size: which rows can have a key that another table has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 24            # 2 MB in all, whatever the number of keys
_BUCKET = 1 << 15         # bits of one row (the size that Spark's bitmap functions use)


def _place(key: Column) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(BITS))


def may_match(df: DataFrame, key: str, keys: DataFrame, other: str) -> DataFrame:
    """The rows of ``df`` whose ``key`` may be among the values of ``other`` in ``keys``; few others
    pass while there are fewer keys than bits. Null keys go. At most 512 rows of 4 KB are broadcast,
    and no wide column of ``df`` is shuffled."""
    place = _place(F.col(other))
    maps = (keys.where(F.col(other).isNotNull()).select(F.floor(place / _BUCKET).alias("_b"), (place % _BUCKET).alias("_p"))
            .groupBy("_b").agg(F.bitmap_construct_agg("_p").alias("_map")))
    here = df.where(F.col(key).isNotNull()).withColumn("_b", F.floor(_place(F.col(key)) / _BUCKET))
    position = _place(F.col(key)) % _BUCKET
    byte = F.conv(F.hex(F.substring("_map", F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return (here.join(F.broadcast(maps), "_b").where(F.getbit(byte, (position % 8).cast("int")) == 1).drop("_b", "_map"))
