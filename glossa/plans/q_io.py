"""Queries for sources and sinks: S1-S7. Each writes the source table to a
fresh folder under the shared checkpoint folder and reads it back, so the
result is what a downstream job would read."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossa.plans import fixtures as X
from glossa.plans.registry import query, r6
from glossa.session import scratch_path
from glossa.sources import io as IO

def _flagship_sql():
    from glossa.plans.q_ensemble import FLAGSHIP_SQL
    return FLAGSHIP_SQL


def _k05_sql():
    from glossa.plans.q_tokens import MAX_LEN, _sql, marks_sql
    return _sql(f"SELECT id, lang, array_to_string({marks_sql('raw_ids', MAX_LEN, True)}, ' ') AS input_ids FROM enc")


COMMENTS_SCHEMA = "id string, lang string, comment_text string, toxic int"
SCORES_SCHEMA = "id string, lang string, toxic double"


@query("s01_csv_scan", X.with_fixtures("SELECT id, lang, comment_text, toxic FROM comments", "comments"))
def s01_csv_scan(spark, sf):
    path = IO.write_csv(X.comments(spark, sf), scratch_path(spark, "comments_csv"))
    return IO.read_csv_ranges(spark, path, COMMENTS_SCHEMA)


@query("s02_zip_csv_scan", X.with_fixtures("SELECT id, lang, comment_text, toxic FROM comments", "comments"))
def s02_zip_csv_scan(spark, sf):
    path = scratch_path(spark, "comments_zip")
    IO.write_zipped_csv(X.comments(spark, sf), path).collect()     # one small row per archive
    return IO.read_zipped_csv(spark, path, COMMENTS_SCHEMA)


@query("s03_glob_scan", X.with_fixtures("SELECT id, lang, model, round(toxic, 6) AS toxic FROM scores", "scores"))
def s03_glob_scan(spark, sf):
    base = scratch_path(spark, "score_files")
    sc = X.scores(spark, sf)
    for m, _, _ in X.SCORE_MODELS:          # one score file per model, as the scorers write them
        IO.write_csv(sc.where(F.col("model") == m).drop("model"), f"{base}/submission_{m}.csv")
    d = IO.read_score_files(spark, f"{base}/submission_*.csv", SCORES_SCHEMA)
    return d.select("id", "lang", "model", r6("toxic").alias("toxic"))


def _chunk_table(spark, sf):
    from glossa.plans.q_sampling import chunks
    return chunks(spark, sf).select("id", "lang", "toxic", "strata", "chunk")


def _chunk_sql(select):
    from glossa.plans.q_sampling import _CHUNKS
    return X.with_fixtures(select, "pool", ctes=_CHUNKS)


@query("s04_chunk_scan", _chunk_sql("SELECT id, lang, toxic, strata, chunk FROM ch WHERE chunk IN (0, 2)"))
def s04_chunk_scan(spark, sf):
    path = IO.write_chunks(_chunk_table(spark, sf), scratch_path(spark, "chunks"))
    return IO.read_chunks(spark, path, [0, 2]).select("id", "lang", "toxic", "strata", "chunk")


@query("s05_csv_sink", _flagship_sql())
def s05_csv_sink(spark, sf):
    from glossa.plans.q_ensemble import flagship
    path = IO.write_csv(flagship(spark, sf), scratch_path(spark, "submission_csv"))
    return IO.read_csv_ranges(spark, path, "id string, toxic double")


@query("s06_chunk_sink", _chunk_sql("SELECT chunk, CAST(count(*) AS BIGINT) AS n FROM ch GROUP BY chunk"))
def s06_chunk_sink(spark, sf):
    path = IO.write_chunks(_chunk_table(spark, sf), scratch_path(spark, "chunks_sink"))
    return IO.read_chunks(spark, path).groupBy("chunk").agg(F.count(F.lit(1)).alias("n"))


@query("s07_token_matrix", _k05_sql())
def s07_token_matrix(spark, sf):
    from glossa.functions import tokens as K
    from glossa.plans.q_tokens import MAX_LEN, encoded, ids_str
    e = encoded(spark, sf, MAX_LEN - 2).select("id", "lang", K.with_marks("raw_ids", MAX_LEN, True).alias("input_ids"))
    path = scratch_path(spark, "token_matrix")
    e.write.mode("overwrite").parquet(path)
    back = spark.read.parquet(path)
    return back.select("id", "lang", ids_str("input_ids").alias("input_ids"))
