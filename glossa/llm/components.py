"""Connected components of a link table, distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.storage import stored


def components(links: DataFrame) -> DataFrame:
    """``s, c`` for every node of ``links`` (``a``, ``b``): ``c`` is the smallest node of its component.

    Each round takes the smallest label among a node and its neighbours and then the label
    of that label, so labels travel twice as far in every round. A node with very many
    links is pre-aggregated before the shuffle. Every round is a stored table."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.where("a <> b").distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("s")).agg(F.least(F.min("b"), F.first("a")).alias("c")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("s", "b"), "b").groupBy(F.col("a").alias("s"))
                .agg(F.min("c").alias("m")))
        step = labels.join(near, "s").select("s", F.col("c").alias("old"), F.least("c", "m").alias("c"))
        step = stored(step, "labels")
        jump = step.select(F.col("s").alias("c"), F.col("c").alias("further"))
        moved = stored(step.join(jump, "c").select("s", "old", F.least("c", "further").alias("c")), "labels")
        labels = moved.select("s", "c")
        if moved.where("c <> old").isEmpty():
            return labels
