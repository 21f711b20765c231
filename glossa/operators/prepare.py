"""Input-file preparation: the composite a training or test file goes through
before scoring or training (P1, P7, G2, G3, T8, K1, K3-K5, S6 in one plan).

    columns by file type -> drop rows with any null -> (train files, when asked)
    stratified chunks on ``lang + str(label)``, capped at ``max_chunk`` ->
    clean + encode -> long-comment action -> rows keyed by ``chunk``

Everything is one DataFrame plan; the only driver-side value is the row count
that decides the number of chunks (a scalar subquery, one number).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.functions import text as T
from glossa.functions import tokens as K
from glossa.operators import sampling as S
from glossa.operators import vocab as V

# --- fixed values ------------------------------------------------------------
# Columns kept per file type.
FILE_COLUMNS = {
    "test": ("id", "lang", "comment_text"),
    "train": ("id", "lang", "comment_text", "toxic_float"),
}
# What to do with comments longer than the model input.
LONG_COMMENT_ACTIONS = ("split", "drop", "ignore")
MAX_LEN = 192
CHUNK_SIZE = 100_000
SPLIT_ENCODE_LEN = 1000
WINDOW = 100
# -----------------------------------------------------------------------------


def check_options(file_type: str, long_comment_action: str) -> None:
    if file_type not in FILE_COLUMNS:
        raise NotImplementedError(f"file type {file_type!r}; expected one of {sorted(FILE_COLUMNS)}")
    if long_comment_action not in LONG_COMMENT_ACTIONS:
        raise ValueError(f"long comment action {long_comment_action!r}; expected one of {LONG_COMMENT_ACTIONS}")


def select_file(df: DataFrame, file_type: str) -> DataFrame:
    """The file type's columns, rows with any null dropped (P1 + P7)."""
    check_options(file_type, "split")
    return df.select(*FILE_COLUMNS[file_type]).na.drop("any")


def with_chunks(df: DataFrame, should_chunk: bool, file_type: str, chunk_size: int = CHUNK_SIZE,
                max_chunk: int | None = None, id_col: str = "id", seed: int = S.SEED) -> DataFrame:
    """Add ``chunk``. Train files asked to chunk get ``rows // chunk_size``
    stratified chunks on ``lang + str(toxic_float)`` when that is more than two,
    keeping chunks below ``max_chunk``; everything else is chunk 0, uncapped."""
    if not (should_chunk and file_type != "test"):
        return df.withColumn("chunk", F.lit(0))
    d = df.withColumn("_strata", T.composite_key("lang", "toxic_float"))
    d = S.stratified_chunks(d, "_strata", chunk_size, id_col, seed=seed).drop("_strata")
    if max_chunk is None:
        return d
    k = F.floor(df.select(F.count(F.lit(1))).scalar() / F.lit(chunk_size))
    return d.where((k <= 2) | (F.col("chunk") < max_chunk))


def long_comment_rows(encoded: DataFrame, action: str, max_len: int = MAX_LEN,
                      split_len: int = SPLIT_ENCODE_LEN, window: int = WINDOW,
                      raw_col: str = "raw_ids") -> DataFrame:
    """``input_ids`` per output row (K3 / K4 / K5); other columns repeat.

    split: encode up to ``split_len``, cut into sliding windows of ``max_len``;
    drop: keep documents whose padded encoding still ends in pad;
    ignore: truncate to ``max_len``."""
    check_options("train", action)
    rest = [c for c in encoded.columns if c != raw_col]
    if action == "split":
        e = encoded.withColumn("_ids", K.with_marks(raw_col, split_len, pad=False))
        w = e.select(*rest, "_ids", F.explode(K.window_starts("_ids", max_len, window)).alias("_start"))
        return w.select(*rest, K.window_ids("_ids", "_start", max_len).alias("input_ids"))
    e = encoded
    if action == "drop":
        e = e.where(F.size(raw_col) + 2 < max_len)
    return e.select(*rest, K.with_marks(raw_col, max_len, pad=True).alias("input_ids"))


def prepare_file(df: DataFrame, file_type: str, vocab: DataFrame, long_comment_action: str = "split",
                 should_chunk: bool = False, max_chunk: int | None = None, chunk_size: int = CHUNK_SIZE,
                 max_len: int = MAX_LEN, vocab_size: int | None = None) -> DataFrame:
    """The whole preparation of one input file; ``id`` must be unique.

    Returns ``id, lang, [toxic_float,] chunk, input_ids`` -- one row per
    document, or per window with the split action. Write it with
    ``sources.io.write_chunks`` to get one folder per chunk."""
    check_options(file_type, long_comment_action)
    d = with_chunks(select_file(df, file_type), should_chunk, file_type, chunk_size, max_chunk)
    carry = [c for c in d.columns if c not in ("id", "comment_text")]
    limit = {"split": {"max_tokens": SPLIT_ENCODE_LEN - 2}, "drop": {"below": max_len - 2}, "ignore": {"max_tokens": max_len - 2}}
    enc = V.encode_ids(d, "id", K.word_tokens("comment_text"), vocab, carry=carry, vocab_size=vocab_size,
                       **limit[long_comment_action]).drop("n_tokens")
    return long_comment_rows(enc, long_comment_action, max_len=max_len)
