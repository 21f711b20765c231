"""Sources and sinks.

CSV is read with an explicit schema (no inference pass), multi-line quoted
fields and RFC-4180 quote doubling. ``read_csv_ranges`` splits files whose cells hold line
breaks: the parity of the quotes before a byte range tells whether it begins inside a cell. Zip
archives are not a Hadoop codec, so they are a data source of their own, whose partitions are the
members of the archives.
"""

from __future__ import annotations

import fnmatch
import io
import uuid
import zipfile
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from glossa.session import materialize

_CSV = {"header": "true", "quote": '"', "escape": '"',
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
        "emptyValue": "", "nullValue": ""}


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | str,
             multi_line: bool = True) -> DataFrame:                                                 # S1 / S3
    """Header CSV with a declared schema; ``path`` may be a glob or a list. ``multi_line``: cells may
    hold line breaks, and a file is read by one task; without it Spark splits files."""
    return _nan_as_null(spark.read.schema(schema).options(**_CSV, multiLine=multi_line).csv(path))


def _nan_as_null(d: DataFrame) -> DataFrame:
    numbers = [f.name for f in d.schema.fields if f.dataType.simpleString() in ("double", "float")]
    return d.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in numbers})      # a NaN cell is missing


RANGE_BYTES = 64 << 20            # byte range of a CSV file that one task reads
READ_BYTES = 4 << 20              # bytes that a task holds at a time
MAX_RANGE_TASKS = 100_000
_RANGE = "path string, start long, stop long"


def csv_ranges(spark: SparkSession, path: str | Sequence[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Byte ranges of the CSV files at ``path`` with ``inside``: whether the range begins within a quoted
    cell. A first job counts the quotes of each range; ``inside`` is the parity of the running
    count over the ranges of a file (one row a range, so the window is small)."""
    files = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("_len"))   # lists, opens nothing
    firsts = F.sequence(F.lit(0).cast("long"), F.col("_len") - 1, F.lit(range_bytes).cast("long"))
    ranges = files.where("_len > 0").select("path", "_len", F.explode(firsts).alias("start"))
    ranges = ranges.select("path", "start", F.least(F.col("start") + range_bytes, F.col("_len")).alias("stop"))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    counted = _one_range_a_task(materialize(ranges)).mapInPandas(_count_quotes, _RANGE + ", quotes long")
    inside = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    return materialize(counted.select("path", "start", "stop", inside.alias("inside")))


def _one_range_a_task(ranges: DataFrame) -> DataFrame:
    # a given number of partitions is kept by adaptive execution, which would merge such small rows otherwise
    return ranges.repartition(max(1, min(MAX_RANGE_TASKS, ranges.count())))


def _open_file(path: str):
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file:///" + path[len("file:"):].lstrip("/")
    if path.endswith((".gz", ".bz2", ".zst", ".deflate", ".snappy", ".lz4")):
        raise ValueError(f"a compressed file has no byte ranges, read it with read_csv: {path}")
    store, p = filesystem_of(path)
    return store.open_input_file(p)


def _count_quotes(batches):
    for pdf in batches:
        found = []
        for path, start, stop in zip(pdf["path"], pdf["start"], pdf["stop"]):
            n = 0
            with _open_file(path) as raw:
                raw.seek(start)
                while start < stop:
                    data = raw.read(min(READ_BYTES, stop - start))
                    if not data:
                        raise OSError(f"{path} has become shorter")
                    n += data.count(b'"')
                    start += len(data)
            found.append(n)
        yield pdf[["path", "start", "stop"]].assign(quotes=found)


def records_of_range(raw, start: int, stop: int, inside: bool, read_bytes: int = READ_BYTES):
    """Lists of ``(position, bytes)`` of the records that begin in ``[start, stop)`` of an open file. A record begins at 0
    and after each line break outside quotes; the last one is read to its end beyond ``stop``."""
    import numpy as np
    at, own, odd = start, start == 0, bool(inside)      # own: the bytes at hand belong to a record of this range
    if start:
        raw.seek(start - 1)
        own = raw.read(1) == b"\n" and not odd
    else:
        raw.seek(0)
    held, first = [], start                             # pieces of the unfinished record, and where it begins
    while own or at < stop:
        data = raw.read(read_bytes)
        if not data:
            break
        codes = np.frombuffer(data, np.uint8)
        quotes, breaks = np.flatnonzero(codes == 34), np.flatnonzero(codes == 10)
        ends = breaks[(np.searchsorted(quotes, breaks) + odd) % 2 == 0]
        out, last = [], 0
        for end in ends.tolist():
            if own:
                held.append(data[last:end])
                out.append((first, b"".join(held)))
            held, last, first = [], end + 1, at + end + 1
            own = first < stop
            if not own:
                break
        if out:
            yield out
        if first >= stop:
            return
        if own:
            held.append(data[last:])
        odd ^= len(quotes) % 2 == 1
        at += len(data)
    if own and held and any(held):
        yield [(first, b"".join(held))]                  # the file does not end with a line break


def _read_records(batches):
    for pdf in batches:
        for path, start, stop, inside in zip(pdf["path"], pdf["start"], pdf["stop"], pdf["inside"]):
            with _open_file(path) as raw:
                for found in records_of_range(raw, start, stop, inside):
                    texts = [r.removesuffix(b"\r").decode("utf-8", "replace") for _, r in found]
                    yield pd.DataFrame({"path": path, "at": [p for p, _ in found], "record": texts})


def read_csv_ranges(spark: SparkSession, path: str | Sequence[str], schema: StructType | str, range_bytes: int = RANGE_BYTES,
                    path_col: str | None = None) -> DataFrame:                                      # S1 / S3
    """The rows of ``read_csv``, with large files read by many tasks although cells hold line breaks. Each
    task cuts the records of its byte range, Spark's own CSV expression turns them into columns; no row is
    shuffled. The first record of a file is its header, empty lines are left out, ``path_col`` names a
    column for the file. Quotes must be those of RFC 4180 (a cell with a quote is quoted, quotes in it
    are doubled); files must not be compressed and lie in a file system that ``pyarrow.fs`` knows."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    ranges = csv_ranges(spark, path, range_bytes)
    records = _one_range_a_task(ranges).mapInPandas(_read_records, "path string, at long, record string")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    cells = F.from_csv("record", ddl, {**_CSV, "header": "false", "multiLine": "true"})
    d = records.where("at > 0 AND record <> ''").select("path", cells.alias("_cells"))
    d = d.select("_cells.*", *([F.col("path").alias(path_col)] if path_col else []))
    return _nan_as_null(d)


def write_csv(df: DataFrame, path: str) -> str:                                                      # S5
    df.write.mode("overwrite").options(**_CSV).csv(path)
    return path


def read_score_files(spark: SparkSession, pattern: str, schema: StructType | str,
                     name_regex: str = r"submission_([^/]+)\.csv", name_col: str = "model",
                     multi_line: bool = True) -> DataFrame:                                       # S3
    """Every CSV matching ``pattern`` with the file's name part as ``name_col``. Files are split into
    byte ranges, or by line without ``multi_line``."""
    if multi_line:
        d = read_csv_ranges(spark, pattern, schema, path_col="_path")
        return d.withColumn(name_col, F.regexp_extract("_path", name_regex, 1)).drop("_path")
    d = read_csv(spark, pattern, schema, multi_line)
    return d.withColumn(name_col, F.regexp_extract(F.col("_metadata.file_path"), name_regex, 1))


def write_chunks(df: DataFrame, path: str, chunk_col: str = "chunk") -> str:                          # S6 / S7
    df.write.mode("overwrite").partitionBy(chunk_col).parquet(path)
    return path


def read_chunks(spark: SparkSession, path: str, chunks: Iterable[int] | None = None,
                chunk_col: str = "chunk") -> DataFrame:                                               # S4
    """Partitioned chunk table; a chunk list becomes a partition filter, so
    unlisted chunk folders are never opened."""
    d = spark.read.parquet(path)
    return d if chunks is None else d.where(F.col(chunk_col).isin(list(chunks)))


def _missing(x) -> bool:
    return pd.isna(x) or x in ("", "NaN")


def _cast_frame(pdf: pd.DataFrame, schema: StructType) -> pd.DataFrame:
    out = {}
    for f in schema.fields:
        s = pdf[f.name] if f.name in pdf.columns else pd.Series([None] * len(pdf), dtype=object)
        t = f.dataType.simpleString()
        if t in ("int", "bigint", "smallint", "tinyint"):
            out[f.name] = pd.array([None if _missing(x) else int(x) for x in s], dtype="Int64")
        elif t in ("double", "float"):
            out[f.name] = pd.array([None if _missing(x) else float(x) for x in s], dtype="Float64")
        else:
            out[f.name] = pd.Series([None if pd.isna(x) or x == "" else x for x in s], index=s.index, dtype=object)
        if t == "string":
            out[f.name] = out[f.name].astype(object)
    return pd.DataFrame(out)


def filesystem_of(uri: str):
    """The ``pyarrow`` file system of a shared folder and the path in it (``file:``, ``hdfs:``,
    ``s3:``/``s3a:``, ``gs:`` or a plain path)."""
    from pyarrow import fs
    if uri.startswith("s3a:"):
        uri = "s3" + uri[3:]
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


MEMBERS_BYTES = 64 << 20          # members of one partition: up to this many unpacked bytes, or one larger member
PART_BYTES = 4 << 20              # characters of a member that a task parses at a time, about
PART_ROWS = 1_000                 # rows that a task parses at a time, at most
FIRST_ROWS = 16


@dataclass
class _Members(InputPartition):
    archive: str
    names: tuple


def _archives(path: str, file_glob: str) -> list[str]:
    from pyarrow import fs
    store, p = filesystem_of(path)
    if store.get_file_info(p).type == fs.FileType.File:
        return [path]
    base = path[:len(path) - len(p)] if path.endswith(p) else ""
    found = store.get_file_info(fs.FileSelector(p))
    return sorted(base + f.path for f in found if f.is_file and fnmatch.fnmatch(f.base_name, file_glob))


class ZippedCsvReader(DataSourceReader):
    """Partitions are members of the archives, found in the central directories. A task opens its archive by
    range, seeks to its members and unpacks them as streams, so no archive and no member is held whole. The rows
    parsed at a time follow the length of the rows before them, so a task's memory does not grow with its rows."""

    def __init__(self, schema: StructType, options: dict):
        self.schema = schema
        self.path = options["path"]
        self.file_glob = options.get("fileglob", "*.zip")
        self.batch_rows = int(options.get("batchrows", str(PART_ROWS)))
        self.members_bytes = int(options.get("membersbytes", str(MEMBERS_BYTES)))

    def partitions(self):
        parts = []
        for archive in _archives(self.path, self.file_glob):
            store, p = filesystem_of(archive)
            with store.open_input_file(p) as raw, zipfile.ZipFile(raw) as zf:
                names, size = [], 0
                for m in zf.infolist():
                    if not m.filename.endswith(".csv"):
                        continue
                    if names and size + m.file_size > self.members_bytes:
                        parts.append(_Members(archive, tuple(names)))
                        names, size = [], 0
                    names.append(m.filename)
                    size += m.file_size
                if names:
                    parts.append(_Members(archive, tuple(names)))
        return parts or [_Members("", ())]

    def read(self, partition):
        if not partition.names:
            return
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        schema = to_arrow_schema(self.schema)
        store, p = filesystem_of(partition.archive)
        with store.open_input_file(p) as raw, zipfile.ZipFile(raw) as zf:
            for name in partition.names:
                with zf.open(name) as fh:
                    for part in _parts(fh, self.batch_rows):
                        yield from pa.Table.from_pandas(_cast_frame(part, self.schema), schema, preserve_index=False).to_batches()


def _parts(fh, most_rows: int, part_bytes: int = PART_BYTES):
    """Frames of an open CSV member, as text. Each has at most twice the rows of the one before, fewer if that was long."""
    rows = min(FIRST_ROWS, most_rows)
    with pd.read_csv(fh, dtype=str, keep_default_na=False, iterator=True) as reader:
        while True:
            try:
                part = reader.get_chunk(rows)
            except StopIteration:
                return
            yield part
            length = sum(int(part[c].str.len().sum()) for c in part.columns)
            rows = max(1, min(most_rows, 2 * rows, rows * part_bytes // max(length, 1)))


class ZippedCsv(DataSource):
    """``spark.read.format("zipped_csv")``: CSV members of zip archives as a partitioned source."""

    @classmethod
    def name(cls):
        return "zipped_csv"

    def schema(self):
        raise ValueError("zipped_csv needs a declared schema")

    def reader(self, schema):
        return ZippedCsvReader(schema, self.options)


def read_zipped_csv(spark: SparkSession, path: str, schema: StructType | str, batch_rows: int = PART_ROWS,
                    file_glob: str = "*.zip", members_bytes: int = MEMBERS_BYTES) -> DataFrame:         # S2
    """Rows of every ``*.csv`` member of the zip archives under ``path`` (a folder, filtered by ``file_glob``,
    or a single archive). Members of up to ``members_bytes`` unpacked bytes share a task; a larger one has its
    own. Empty fields are null. No archive or no member gives no rows."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    spark.dataSource.register(ZippedCsv)
    return (spark.read.format("zipped_csv").schema(schema).option("fileglob", file_glob)
            .option("batchrows", str(batch_rows)).option("membersbytes", str(members_bytes)).load(path))


def _csv_record(cols: Sequence[str]) -> F.Column:
    """A row as a CSV record with its line break; cells are quoted where they must be, a missing one is empty."""
    def cell(c):
        text = F.col(c).cast("string")
        quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.coalesce(F.when(text.rlike('[",\r\n]'), quoted).otherwise(text), F.lit(""))
    record = F.concat_ws(",", *[cell(c) for c in cols])
    # a record without any character would be a blank line, which readers leave out
    return F.concat(F.when(record == "", F.lit('""')).otherwise(record), F.lit("\n"))


def write_zipped_csv(df: DataFrame, path: str) -> DataFrame:                                          # S2 (writer)
    """Each non-empty partition streams into one ``part-<n>.csv.zip`` in the shared folder ``path``,
    batch by batch; returns the written paths and row counts as a DataFrame (lazy). Spark makes the records;
    a task passes the bytes of each Arrow batch on and makes no Python object of a cell."""
    cols = df.columns
    if path.startswith("file:"):
        path = "file:///" + path[len("file:"):].lstrip("/")

    def write(batches):
        import csv

        import pyarrow as pa
        from pyspark import TaskContext
        store, folder = filesystem_of(path)
        store.create_dir(folder, recursive=True)
        # named by partition: a retried task replaces its own file, never adds one
        target = f"{folder}/part-{TaskContext.get().partitionId():05d}.csv.zip"
        part = f"{target}.{uuid.uuid4().hex}.tmp"
        rows = 0
        head = io.StringIO()
        csv.writer(head, lineterminator="\n").writerow(cols)
        with (store.open_output_stream(part, compression=None) as raw,
              zipfile.ZipFile(raw, "w", compression=zipfile.ZIP_DEFLATED) as zf,
              zf.open("data.csv", "w", force_zip64=True) as member):
            for batch in batches:
                if not rows:
                    member.write(head.getvalue().encode())
                for record in batch.column(0):
                    member.write(record.as_buffer())
                rows += batch.num_rows
        if rows:
            store.move(part, target)
            yield pa.RecordBatch.from_pylist([{"path": target, "rows": rows}])
        else:
            store.delete_file(part)

    return df.select(_csv_record(cols).alias("record")).mapInArrow(write, "path string, rows long")
