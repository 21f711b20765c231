"""Stateless text preparation on a stream.

The reference has no streaming operators. Cleaning (T1-T14) and token-array
functions (K1, K3-K8) are per-row column expressions, so the same code runs
unchanged on a streaming DataFrame; this module wires them to a file source
and a parquet sink with a checkpoint in the shared folder (exactly-once file
sink, restartable after executor or driver loss).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.functions import text as T


def read_documents_stream(spark: SparkSession, src_dir: str, schema: str, max_files: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(src_dir)


def cleaned(stream: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, lang, comment_text`` (T11), ``has_ip`` (T12), ``is_bot_msg``."""
    return stream.select(F.col(id_col).cast("string").alias("id"), "lang",
                         T.clean_text_mono(text_col).alias("comment_text"),
                         T.has_ipv4(text_col).alias("has_ip"),
                         T.is_template_message(text_col).alias("is_bot_msg"))


def run_available(df: DataFrame, out_dir: str, checkpoint_dir: str):
    """Process everything available now into ``out_dir`` and stop."""
    q = (df.writeStream.format("parquet").option("path", out_dir)
         .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
