"""Operator 3, mixing sources to target weights by Poisson replication.

Each source gets a repetition rate: target weight x tokens wanted / tokens it has. Each
document draws its number of copies from a Poisson distribution with that mean, by
inverting the distribution at uniforms hashed from (seed, id, text checksum); a large rate is
the sum of independent parts of at most ``PART``. Copies are exploded and shuffled globally
by a hashed key. Source sizes come from one partial aggregate over all rows, so a source
with a third of all rows is no hot key; rates are joined back as a table of checked size.

Defined results: a null source is a source of its own; a source of no words gets rate 0 and
is left out, as is one whose target weight is 0 or not given; a null text has no words;
equal rows draw equal numbers; input columns that clash with added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.functions.rand import uniform
from glossa.llm.storage import join_small, stored
from glossa.llm.texts import WORD_SPLIT

SEED = 41
TEMPERATURE = 0.5          # without given weights, a source weighs words ** TEMPERATURE
EPOCHS = 1.0               # words of the mixture, in words of the input
PART = 8.0                 # largest mean that is inverted at once
TERMS = 64                 # terms of the inversion; beyond, a mean of PART has probability below 2**-52


def n_words(text: Column) -> Column:
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.size(F.filter(F.split(text, WORD_SPLIT), lambda w: w != "")).cast("long")


def source_rates(docs: DataFrame, source_col: str = "source", text_col: str = "text",
                 weights: dict[str, float] | None = None, epochs: float = EPOCHS,
                 temperature: float = TEMPERATURE) -> DataFrame:
    """``source, n_docs, n_words, rate``: one row per source."""
    spark = docs.sparkSession
    sizes = stored(docs.groupBy(F.col(source_col).alias("source"))
                   .agg(F.count(F.lit(1)).alias("n_docs"), F.sum(n_words(F.col(text_col))).alias("n_words")), "sources")
    if weights is None:
        weighed = sizes.withColumn("weight", F.when(F.col("n_words") > 0, F.pow(F.col("n_words").cast("double"), temperature))
                                   .otherwise(0.0))
    else:
        given = spark.createDataFrame([(k, float(w)) for k, w in weights.items()], "source string, weight double")
        match = sizes["source"].eqNullSafe(given["source"])
        weighed = sizes.join(F.broadcast(given), match, "left").select(
            sizes["source"], "n_docs", "n_words", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    all_words = weighed.select(F.sum("n_words")).scalar()
    all_weight = weighed.select(F.sum(F.when(F.col("n_words") > 0, F.col("weight")))).scalar()
    rate = F.col("weight") / all_weight * all_words * F.lit(float(epochs)) / F.col("n_words")
    return weighed.select(
        "source", "n_docs", "n_words", F.when((F.col("n_words") > 0) & (F.col("weight") > 0), rate).otherwise(0.0).alias("rate"))


def poisson(rate: Column, *key) -> Column:
    """A Poisson number with mean ``rate`` from uniforms hashed from ``key``."""
    parts = F.greatest(F.lit(1), F.ceil(rate / F.lit(PART)))
    mean = rate / parts

    def one(part: Column) -> Column:
        u = uniform(*key, part)
        start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("c"), (u >= F.exp(-mean)).cast("int").alias("k"))

        def step(acc: Column, j: Column) -> Column:           # c: probability of at most j
            p = acc["p"] * mean / j
            return F.struct(p.alias("p"), (acc["c"] + p).alias("c"), (acc["k"] + (u >= acc["c"] + p).cast("int")).alias("k"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step, lambda acc: acc["k"])

    drawn = F.aggregate(F.sequence(F.lit(1).cast("long"), parts.cast("long")), F.lit(0), lambda n, part: n + one(part))
    return F.when(rate > 0, drawn).otherwise(F.lit(0))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights: dict[str, float] | None = None, epochs: float = EPOCHS, seed: int = SEED) -> DataFrame:
    """The rows of ``docs``, each as often as drawn, in a global hashed order (range-partitioned and
    sorted by ``mix_key``), with ``copy`` (from 1), ``rate`` and ``mix_key``."""
    rates = stored(source_rates(docs, source_col, text_col, weights, epochs), "rates")
    rates = rates.select(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("_s"), F.col("rate").alias("_rate"))
    check = F.crc32(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))
    d = docs.select(F.struct(*docs.columns).alias("_r"), F.coalesce(F.concat(F.lit("s"), source_col), F.lit("")).alias("_s"),
                    F.concat_ws(":", F.col(id_col).cast("string"), check.cast("string")).alias("_key"))
    d = join_small(d, rates, ["_s"])
    d = d.withColumn("_n", poisson(F.col("_rate"), seed, F.col("_key"))).where("_n > 0")
    d = d.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    d = d.withColumn("_mix", uniform(seed + 1, F.col("_key"), F.col("_copy")))
    d = d.repartitionByRange("_mix", "_key", "_copy").sortWithinPartitions("_mix", "_key", "_copy")
    own = {"copy": F.col("_copy"), "rate": F.col("_rate"), "mix_key": F.col("_mix")}
    return d.select(*[F.col("_r")[c].alias(c) for c in docs.columns if c not in own], *[x.alias(k) for k, x in own.items()])


