"""The stateless cleaning runs unchanged on a stream and equals the batch result."""

from glossa.functions import text as T
from glossa.session import scratch_path
from glossa.streaming import text_stream as S
from pyspark.sql import functions as F

from conftest import SF0001


def test_stream_equals_batch(spark):
    src = f"{SF0001}/documents.parquet"
    schema = spark.read.parquet(src).schema.simpleString()[len("struct<"):-1].replace(":", " ")
    out, ck = scratch_path(spark, "stream_out"), scratch_path(spark, "stream_ck")
    # a parquet file source reads a directory; point it at a folder holding the table
    d = scratch_path(spark, "stream_src")
    spark.read.parquet(src).write.parquet(d)
    S.run_available(S.cleaned(S.read_documents_stream(spark, d, schema)), out, ck)
    got = spark.read.parquet(out).select("id", "comment_text").collect()
    want = spark.read.parquet(src).select(F.col("doc_id").cast("string").alias("id"),
                                          T.clean_text_mono("text").alias("comment_text")).collect()
    assert sorted(got) == sorted(want)
