"""Whole-file preparation: option errors, column selection, chunk cap and the
three long-comment actions on hand rows."""

import pytest
from pyspark.sql import functions as F

from glossa.operators import prepare as P

VOCAB = [("a", 4), ("b", 5)]


def _vocab(spark):
    return spark.createDataFrame(VOCAB, "token string, token_id int")


def _file(spark, rows):
    return spark.createDataFrame(rows, "id string, lang string, comment_text string, toxic_float double, extra int")


def test_unknown_options_raise(spark):
    df = _file(spark, [("1", "en", "a b", 0.0, 1)])
    with pytest.raises(NotImplementedError):
        P.prepare_file(df, "valid", _vocab(spark))
    with pytest.raises(ValueError):
        P.prepare_file(df, "train", _vocab(spark), long_comment_action="keep")


def test_columns_by_type_and_null_drop(spark):
    df = _file(spark, [("1", "en", "a b c", 0.5, 1), ("2", "fr", None, 0.0, 1), ("3", "fr", "b", None, None)])
    test = P.prepare_file(df, "test", _vocab(spark), long_comment_action="ignore", max_len=6)
    assert test.columns == ["id", "lang", "chunk", "input_ids"]
    # the test file keeps row 3 (its label is not one of its columns)
    assert {r.id: r.input_ids for r in test.collect()} == {"1": [0, 4, 5, 3, 2, 1], "3": [0, 5, 2, 1, 1, 1]}
    train = P.prepare_file(df, "train", _vocab(spark), long_comment_action="ignore", max_len=6)
    assert train.columns == ["id", "lang", "toxic_float", "chunk", "input_ids"]
    assert [r.id for r in train.collect()] == ["1"]


def test_drop_and_split_actions(spark):
    long_text = " ".join(["a"] * 10)
    df = _file(spark, [("s", "en", "a b", 1.0, 0), ("l", "en", long_text, 0.0, 0)])
    drop = P.prepare_file(df, "train", _vocab(spark), long_comment_action="drop", max_len=6)
    assert [r.id for r in drop.collect()] == ["s"]
    split = P.long_comment_rows(
        spark.createDataFrame([("l", list(range(10, 20)))], "id string, raw_ids array<int>"),
        "split", max_len=6, split_len=100, window=2)
    got = [r.input_ids for r in split.collect()]
    # content 10..19 in windows of 4 starting every 2 ids, until the end is reached
    assert got == [[0, 10, 11, 12, 13, 2], [0, 12, 13, 14, 15, 2], [0, 14, 15, 16, 17, 2], [0, 16, 17, 18, 19, 2]]


def test_chunk_cap_applies_only_when_chunked(spark):
    rows = [(str(i), "en" if i % 2 else "fr", "a", float(i % 3) / 10, 0) for i in range(40)]
    df = _file(spark, rows)
    # 40 rows // 10 = 4 chunks; the cap keeps chunks 0 and 1
    capped = P.prepare_file(df, "train", _vocab(spark), "ignore", should_chunk=True, max_chunk=2, chunk_size=10)
    sizes = dict(capped.groupBy("chunk").count().collect())
    assert sizes == {0: 10, 1: 10}
    # 40 // 20 = 2 chunks is not more than two: one chunk 0, the cap does not apply
    one = P.prepare_file(df, "train", _vocab(spark), "ignore", should_chunk=True, max_chunk=0, chunk_size=20)
    assert one.select(F.collect_set("chunk")).first()[0] == [0] and one.count() == 40
    # test files are never chunked
    t = P.prepare_file(df, "test", _vocab(spark), "ignore", should_chunk=True, max_chunk=2, chunk_size=10)
    assert t.where(F.col("chunk") != 0).count() == 0 and t.count() == 40
