"""Driver contract, sources/sinks, and a few oracle comparisons at sf0.001."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from glossa.session import scratch_path
from glossa.sources import io as IO
from glossa.sources.tables import TABLES

from conftest import SF0001


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "toxic"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 90


@pytest.mark.parametrize("key", ["e09_post_process", "a10_roc_auc", "g02_stratified_chunks", "au04_length_router",
                                 "k03_split_windows", "w01_pct_rank"])
def test_oracle_sf0001(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    cur = con.execute(entry.oracle_sql()[key])
    cols = [d[0] for d in cur.description]
    want = sorted(tuple(r[cols.index(c)] for c in sorted(cols)) for r in cur.fetchall())
    df = entry.queries()[key](spark, SF0001)
    got = sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())
    assert sorted(df.columns) == sorted(cols)
    assert got == want


def test_csv_roundtrip_multiline(spark):
    rows = [("1", 'he said "hi"\nthen left', None), ("2", "  padded  ", 3), ("3", "", 0)]
    df = spark.createDataFrame(rows, "id string, t string, n int")
    back = IO.read_csv(spark, IO.write_csv(df, scratch_path(spark, "t_csv")), "id string, t string, n int")
    # like pandas.read_csv, an empty field reads back as missing
    want = [("1", 'he said "hi"\nthen left', None), ("2", "  padded  ", 3), ("3", None, 0)]
    assert sorted(tuple(r) for r in back.collect()) == sorted(want)


def test_single_line_csv_is_split(spark):
    path = scratch_path(spark, "t_split")
    spark.range(20_000).selectExpr("cast(id AS string) AS id", "'text' AS t").coalesce(1).write.option("header", True).csv(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        d = IO.read_csv(spark, path, "id string, t string", multi_line=False)
        assert d.rdd.getNumPartitions() > 1 and d.count() == 20_000
        assert IO.read_csv(spark, path, "id string, t string").rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_zip_writer_streams_batches_and_skips_empty_partitions(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        path = scratch_path(spark, "t_zip_batches")
        df = spark.range(0, 1_000, 1, 3).where("id < 400").selectExpr("id", "concat('zeile ', id, ' ä') AS t")
        done = IO.write_zipped_csv(df, path).collect()
        assert sum(r["rows"] for r in done) == 400 and len(done) == 2
        back = IO.read_zipped_csv(spark, path, "id long, t string")
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_zip_roundtrip(spark):
    df = spark.createDataFrame([("1", "a,b", 2), ("2", "x\ny", None)], "id string, t string, n int").repartition(2)
    path = scratch_path(spark, "t_zip")
    IO.write_zipped_csv(df, path).collect()
    back = IO.read_zipped_csv(spark, path, "id string, t string, n int")
    assert sorted(back.collect()) == sorted(df.collect())


def test_members_of_one_archive_are_partitions(spark, tmp_path):
    import zipfile
    path = str(tmp_path / "two.csv.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for name, ids in (("a.csv", range(0, 500)), ("b.csv", range(500, 900)), ("notes.txt", [])):
            zf.writestr(name, "id,t\n" + "".join(f'{i},"x\n{i}"\n' for i in ids))
    for most, parts in ((1, 2), (1 << 20, 1)):
        d = IO.read_zipped_csv(spark, path, "id long, t string", members_bytes=most, batch_rows=100)
        assert d.rdd.getNumPartitions() == parts
        assert sorted(map(tuple, d.collect())) == [(i, f"x\n{i}") for i in range(900)]
    assert IO.read_zipped_csv(spark, str(tmp_path), "id long", file_glob="none*.zip").count() == 0


def test_chunk_scan_prunes_partitions(spark):
    df = spark.range(30).withColumn("chunk", (F.col("id") % 5).cast("int"))
    path = IO.write_chunks(df, scratch_path(spark, "t_chunks"))
    sel = IO.read_chunks(spark, path, [1, 3])
    plan = sel._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "chunk" in plan
    assert sorted(r.chunk for r in sel.select("chunk").distinct().collect()) == [1, 3]


def test_both_csv_readers_agree_on_awkward_cells(spark):
    import pandas as pd
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL("id long, t string, x double")
    cells = pd.DataFrame({"id": ["9007199254740993", "", "7"], "t": ["", "a,b", "NaN"], "x": ["NaN", "0.5", ""]})
    assert IO._cast_frame(cells, schema).astype(object).where(lambda d: d.notna(), None).values.tolist() == [
        [9007199254740993, None, None], [None, "a,b", 0.5], [7, "NaN", None]]
    path = scratch_path(spark, "t_awkward")
    spark.createDataFrame(cells).coalesce(1).write.option("header", True).csv(path)
    got = sorted(map(tuple, IO.read_csv(spark, path, schema).collect()), key=str)
    assert got == sorted([(9007199254740993, None, None), (None, "a,b", 0.5), (7, "NaN", None)], key=str)


def test_zip_reader_parts_follow_the_length_of_the_rows(tmp_path):
    import zipfile
    from pyspark.sql.types import StructType
    path = str(tmp_path / "long.csv.zip")
    cells = ["x" * 10] * 3000 + ["y" * 20_000] * 1000 + ["z"] * 100
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("a.csv", "id,t\n" + "".join(f"{i},{c}\n" for i, c in enumerate(cells)))
    reader = IO.ZippedCsvReader(StructType.fromDDL("id long, t string"), {"path": path})
    got = [b for p in reader.partitions() for b in reader.read(p)]
    assert max(b.num_rows for b in got) <= IO.PART_ROWS
    # one part may be as many rows as the short ones before it, the next ones are cut
    assert sorted(b.nbytes for b in got)[-2] < 2 * IO.PART_BYTES
    assert [v for b in got for v in b.column(0).to_pylist()] == list(range(len(cells)))
    assert [v for b in got for v in b.column(1).to_pylist()] == cells


def test_zip_writer_quotes_as_csv(spark):
    rows = [("a,b", 'say "hi"', 1), ("line\nbreak", "cr\r\nlf", None), (None, None, None), (" lead", "", 2), ('"', "é€", 3)]
    path = scratch_path(spark, "t_zip_quotes")
    IO.write_zipped_csv(spark.createDataFrame(rows, "a string, b string, n int").coalesce(1), path).collect()
    back = IO.read_zipped_csv(spark, path, "a string, b string, n int").collect()
    assert [tuple(r) for r in back] == [tuple(x if x != "" else None for x in r) for r in rows]
    one = scratch_path(spark, "t_zip_one")
    IO.write_zipped_csv(spark.createDataFrame([("x",), (None,), ("y",)], "a string").coalesce(1), one).collect()
    assert [r.a for r in IO.read_zipped_csv(spark, one, "a string").collect()] == ["x", None, "y"]
