"""A training-data pipeline over ``documents``: quality classifier, near-dedup,
decontamination, mixing, sharding. Each stage takes (spark, docs, sf_dir) and returns a
DataFrame; the next one reads what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from glossa.llm import decontaminate, mixing, near_dedup, quality_bayes, sharding
from glossa.llm.storage import stored
from glossa.session import ensure_checkpoint_dir, ship_package
from glossa.sources.tables import load


def _ready(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that the classifier rejects go."""
    _ready(spark)
    return quality_bayes.keep_good(docs, load(spark, sf_dir, "labels"))


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of each group of near-duplicates one row of the smallest id stays."""
    _ready(spark)
    return near_dedup.keep_single(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that hold a benchmark item go."""
    _ready(spark)
    return decontaminate.keep_clean(docs, load(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents repeat at the rates of their sources."""
    _ready(spark)
    return mixing.mix(docs).select(*docs.columns)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: the rows in eight shards of equal size, with ``shard`` and ``slot``."""
    _ready(spark)
    return sharding.shard(docs, ["doc_id", "text", "source"])


STAGES = [("quality classifier", quality), ("near-dedup", near_dups), ("decontamination", decontaminated),
          ("mixing", mixed), ("sharding", sharded)]

#: SQL has no circulant MinHash, no fitted classifier and no hypergeometric draws; see tests/llm/test_corpus_operators.py
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        docs = out if name == STAGES[-1][0] else stored(out, "stage")
    return docs
