"""Deterministic, partition-independent randomness keyed by md5.

A draw is ``u(seed, k1, k2, ...)``: the first 52 bits of
``md5('seed|k1|k2|...')`` divided by 2**52, so 0 <= u < 1. The same keys give
the same draw whatever the partitioning, task retries or engine (the SQL twin
is in ``glossa.plans.sqlkit``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_52 = 4503599627370496.0


def _as_col(x) -> Column:
    if isinstance(x, Column):
        return x.cast("string")
    return F.lit(str(x))


def md5_key(*parts) -> Column:
    return F.md5(F.concat_ws("|", *[_as_col(p) for p in parts]))


def uniform(*parts) -> Column:
    """Uniform double in [0, 1) keyed by ``parts`` (str/int literals or Columns)."""
    h = md5_key(*parts)
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("bigint") / F.lit(TWO_POW_52)


def uniform_below(p: float, *parts) -> Column:
    """``uniform(*parts) < p``, by comparing the hash with the hexadecimal digits of the least number that is not below."""
    n = max(0, math.ceil(p * TWO_POW_52))
    return F.lit(True) if n >= TWO_POW_52 else md5_key(*parts) < F.lit(f"{n:013x}")


def randint(lo: int, hi_exclusive: int, *parts) -> Column:
    """Integer uniform in [lo, hi_exclusive)."""
    return (F.floor(uniform(*parts) * F.lit(hi_exclusive - lo)) + F.lit(lo)).cast("int")
