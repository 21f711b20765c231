"""Corpora for masked-language training, each text encoded once.

A text may belong to several corpora, some of them capped. Membership is a bitmask that a
projection computes: the cap of a corpus becomes the order key of its last row, found on the narrow
keys, so no text is shuffled for it. Texts of no corpus drop out, the others are encoded and
masked once, and corpora become rows at the very end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.functions import rand
from glossa.operators.scale import row_number_by_uniform


def _has(bits: Column, place: int) -> Column:
    return bits.bitwiseAND(F.lit(1 << place)) != 0


def cut_members(texts: DataFrame, corpora: Sequence[str], caps: dict[str, int], keys: Sequence[str], seed: int,
                bits: str = "bits") -> DataFrame:
    """``texts`` with ``bits`` (bit i: candidate of ``corpora[i]``) cut to the members: of a corpus in
    ``caps`` the first rows of the seeded order of (corpus, keys). ``keys`` are unique. Texts without a corpus drop out."""
    keys = list(keys)
    place = {c: i for i, c in enumerate(corpora)}
    names = F.array_compact(F.array(*[F.when(_has(F.col(bits), place[c]), F.lit(c)) for c in caps]))
    narrow = texts.select(F.explode(names).alias("_corpus"), *keys)
    narrow = narrow.withColumn("_u", rand.uniform(seed, F.col("_corpus"), *[F.col(k) for k in keys]))
    placed = row_number_by_uniform(narrow, "_u", keys, ["_corpus"], out_col="_rn")
    cap = F.create_map(*[F.lit(x) for kv in caps.items() for x in kv])[F.col("_corpus")]
    # one row for each capped corpus that has more candidates than its cap allows
    last = placed.where(F.col("_rn") == cap).select("_corpus", F.struct("_u", *keys).alias("_last"))
    last = last.agg(F.map_from_entries(F.collect_list(F.struct("_corpus", "_last"))).alias("m"))
    d = texts.withColumn("_last", last.scalar())           # bound once: each reference would be a subquery of its own
    kept = F.lit(0)
    for c, i in place.items():
        member = _has(F.col(bits), i)
        if c in caps:
            until = F.try_element_at("_last", F.lit(c))
            own = F.struct(rand.uniform(seed, F.lit(c), *[F.col(k) for k in keys]).alias("_u"), *keys)
            member = member & (until.isNull() | (own <= until))
        kept = kept + F.when(member, F.lit(1 << i)).otherwise(F.lit(0))
    return d.withColumn(bits, kept).drop("_last").where(F.col(bits) != 0)


def by_corpus(df: DataFrame, corpora: Sequence[str], bits: str = "bits") -> DataFrame:
    """One row for each corpus of a row, with ``corpus`` in place of ``bits``."""
    names = F.array_compact(F.array(*[F.when(_has(F.col(bits), i), F.lit(c)) for i, c in enumerate(corpora)]))
    return df.select(F.explode(names).alias("corpus"), *[c for c in df.columns if c != bits])
