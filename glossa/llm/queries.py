"""The registered queries of the thirteen operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from glossa.llm import (collocations, decontaminate, mixing, near_dedup, quality_bayes, quality_rules, sharding,
                        substring_dedup, suffix_dedup, token_counts, toxicity, warc, whitening)
from glossa.sources.tables import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: the operators that SQL can express in reasonable time; the others are tested against brute force
ORACLE: dict[str, str] = {"op1_substring_dedup": substring_dedup.ORACLE_SQL, "op4_near_dedup": near_dedup.ORACLE_SQL,
                          "op5_quality_rules": quality_rules.ORACLE_SQL, "op6_suffix_dedup": suffix_dedup.ORACLE_SQL,
                          "op9_warc": warc.ORACLE_SQL, "op11_collocations": collocations.ORACLE_SQL}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_substring_dedup(spark, sf_dir):
    return substring_dedup.digest(substring_dedup.dedup_substrings(load(spark, sf_dir, "documents")))


@query
def op2_token_counts(spark, sf_dir):
    return token_counts.token_counts(load(spark, sf_dir, "documents"))


@query
def op3_mixing(spark, sf_dir):
    d = load(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(d).select("doc_id", "source", "copy", "rate", "mix_key")


@query
def op4_near_dedup(spark, sf_dir):
    return near_dedup.digest(near_dedup.near_duplicates(load(spark, sf_dir, "documents")))


@query
def op5_quality_rules(spark, sf_dir):
    return quality_rules.digest(quality_rules.quality_rules(load(spark, sf_dir, "documents")))


@query
def op6_suffix_dedup(spark, sf_dir):
    return suffix_dedup.digest(suffix_dedup.dedup_suffixes(load(spark, sf_dir, "documents")))


@query
def op7_quality_classifier(spark, sf_dir):
    return quality_bayes.digest(quality_bayes.classify(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")))


@query
def op8_decontamination(spark, sf_dir):
    return decontaminate.contaminated(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


@query
def op9_warc(spark, sf_dir):
    return warc.digest(warc.archive_pages(spark, load(spark, sf_dir, "pages")))


@query
def op10_sharding(spark, sf_dir):
    d = sharding.with_digest(load(spark, sf_dir, "documents"))
    return sharding.digest(sharding.shard(d, ["doc_id", "text_crc32", "size"]))


@query
def op11_collocations(spark, sf_dir):
    return collocations.digest(collocations.collocations(load(spark, sf_dir, "documents")))


@query
def op12_toxicity(spark, sf_dir):
    return toxicity.digest(toxicity.toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")))


@query
def op13_whitening(spark, sf_dir):
    return whitening.digest(whitening.whiten(load(spark, sf_dir, "embeddings")))
