"""CSV files whose cells hold line breaks, read by byte ranges."""

import io

import pytest
from hypothesis import given, settings, strategies as st

from glossa.session import scratch_path
from glossa.sources import io as IO

SCHEMA = "id string, t string, n int, x double"
AWKWARD = ('id,t,n,x\n1,"a\nb",2,0.5\n2,"he said ""hi""\n\nthen, left",,NaN\n\n3,"""",7,\n4,plain,x,1e3\n'
           '5,"\r\nä€\r\n",-1,2\n6,"",3,0\n7,"' + "long\n" * 200 + '",8,9\n8,last,9,10')


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("range_bytes", [1, 7, 64, 1 << 20])
def test_ranges_equal_the_reader_of_whole_files(spark, tmp_path, range_bytes):
    for name, text in (("a.csv", AWKWARD), ("b.csv", AWKWARD.replace("last", "end") + "\n"), ("empty.csv", ""), ("head.csv", "id,t,n,x\n")):
        (tmp_path / name).write_bytes(text.encode())
    whole = IO.read_csv(spark, str(tmp_path), SCHEMA)
    if range_bytes > 1:
        assert _rows(IO.read_csv_ranges(spark, str(tmp_path), SCHEMA, range_bytes)) == _rows(whole)
        return
    raw = io.BytesIO(AWKWARD.encode())          # a range of every byte, without Spark
    quotes, got = 0, []
    for i in range(len(raw.getvalue())):
        for found in IO.records_of_range(raw, i, i + 1, quotes % 2 == 1, read_bytes=5):
            got += found
        quotes += raw.getvalue()[i:i + 1] == b'"'
    want = [r for found in IO.records_of_range(raw, 0, len(raw.getvalue()), False) for r in found]
    assert got == want and len([r for _, r in want if r]) == 9


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet='ab,"\n\r', max_size=60), st.integers(1, 9), st.integers(1, 9))
def test_each_record_is_in_one_range(text, width, read_bytes):
    data = text.encode()
    raw = io.BytesIO(data)
    got = []
    for start in range(0, len(data), width):
        inside = data[:start].count(b'"') % 2 == 1
        for found in IO.records_of_range(raw, start, min(start + width, len(data)), inside, read_bytes):
            got += found
    want, first, odd = [], 0, False
    for i, c in enumerate(data):
        odd ^= c == 34
        if c == 10 and not odd:
            want.append((first, data[first:i]))
            first = i + 1
    if first < len(data):
        want.append((first, data[first:]))
    assert got == want


def test_one_file_is_read_by_many_tasks_without_a_shuffle_of_rows(spark):
    path = scratch_path(spark, "t_ranges")
    spark.range(5_000).selectExpr("cast(id AS string) AS id", "concat('line\n', id) AS t").coalesce(1).write.options(
        header=True, quote='"', escape='"').csv(path)
    d = IO.read_csv_ranges(spark, path, "id string, t string", range_bytes=8_192)
    assert d.rdd.getNumPartitions() > 8
    assert _rows(d) == sorted((str(i), f"line\n{i}") for i in range(5_000))
    from pyspark.sql import functions as F
    tasks = d.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 8
    files = IO.read_csv_ranges(spark, path, "id string, t string", path_col="file").select("file").distinct().collect()
    assert len(files) == 1 and files[0].file.endswith(".csv")


def test_compressed_files_are_an_error(spark):
    path = scratch_path(spark, "t_gz")
    spark.range(3).write.option("header", True).option("compression", "gzip").csv(path)
    with pytest.raises(Exception, match="compressed"):
        IO.read_csv_ranges(spark, path, "id long").collect()
