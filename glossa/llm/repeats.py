"""Windows that occur again later in the corpus: the work shared by the two exact
substring operators (words: ``substring_dedup``; bytes: ``suffix_dedup``).

1. Every document is cut into super-k-mers (``segments``). One narrow row per
   super-k-mer goes to the task of its minimiser; a minimiser that occurs once
   cannot repeat and ends there. Equal super-k-mers need no text: all but the first
   repeat in full.
2. Only super-k-mers that share a minimiser and differ are sent as packed text
   to the bucket of their minimiser. There their windows are sorted, and all
   but the first of a class of equal windows are repeats.

Skew: minimisers frequent in a bounded sample are salted in step 1 (the sample
chooses the plan, never the result), and step 1 streams through each minimiser
with constant memory. In step 2 a bucket holds at most ``BUCKET`` super-k-mers;
the windows of fuller buckets are sorted across all tasks by range instead, and
classes that run over the edge of a range are settled from one row per range. No step drops or caps rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.segments import BYTE_HASH, SLICE, gram_hashes, mix, super_kmers
from glossa.llm.storage import join_small, stored
from glossa.llm.texts import utf8_column, word_bounds, word_hashes

SAMPLE_DOCS = 5_000        # documents read to find frequent minimisers
SAMPLE_HOT = 25            # occurrences in the sample that make a minimiser salted
HOT_MAX = 20_000           # most frequent minimisers kept on the driver (the sample bounds their number)
BUCKET = 1_000             # super-k-mers compared in one bucket
NO_ID = (1 << 63) - 1      # place in the order of a document without id: after all others


@dataclass(frozen=True)
class Unit:
    """What a window is made of. ``by_document``: a window repeats only if it also starts
    in an *earlier document*; otherwise any earlier start counts."""
    words: bool
    width: int
    gram: int
    by_document: bool


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``o``, ``v``, ``text``: the order of a document (its id) and a 64-bit checksum that keeps
    documents apart that share an id or have none."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("o"),
                       F.xxhash64(text).alias("v"), text.alias("text"), F.col(id_col).cast("long").alias("id"))


def repeated_windows(docs: DataFrame, unit: Unit) -> DataFrame:
    """``o, v, spans``: for each document of ``docs`` (``keyed``) that has repeated windows,
    the runs ``{start, n}`` of their starts (runs may overlap)."""
    hot = _frequent_minimisers(docs, unit)
    n_salts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.mapInArrow(_emit_segments(unit, hot, n_salts), _SEGMENT)
    first = (rows.repartition("mini", "salt")
             .sortWithinPartitions("mini", "salt", "content", "o", "v", "start")
             .mapInArrow(_first_pass(unit, hot), _FIRST))
    first = stored(first, "segments")
    spans = first.where(F.col("mini").isNull()).select("o", "v", "start", "n")
    spans = spans.unionByName(_compare_windows(docs, first.where(F.col("mini").isNotNull()), unit))
    return spans.groupBy("o", "v").agg(F.collect_list(F.struct("start", "n")).alias("spans"))


# ------------------------------------------------------------------ step 1: super-k-mers

_SEGMENT = "mini long, salt int, content long, o long, v long, start int, n int"
_FIRST = "mini long, o long, v long, start int, n int"


def _elements(text, unit: Unit) -> np.ndarray:
    return word_hashes(text) if unit.words else np.frombuffer(text, np.uint8)


def _hashed(elements: np.ndarray, unit: Unit) -> np.ndarray:
    return elements if unit.words else BYTE_HASH[elements]


def _segments_of(text, unit: Unit):
    """Yields ``(mini, content, start, n)`` arrays of each slice of one text."""
    elements = _elements(text, unit)
    windows = len(elements) - unit.width + 1
    for a in range(0, windows, SLICE):
        b = min(windows, a + SLICE)
        mini, content, start, n = super_kmers(_hashed(elements[a:b + unit.width - 1], unit), unit.width, unit.gram)
        yield mini.view(np.int64), content.view(np.int64), start + a, n


def _emit_segments(unit: Unit, hot: np.ndarray, n_salts: int):
    def run(batches):
        for batch in batches:
            o, v = (batch.column(c).to_numpy() for c in ("o", "v"))
            parts, size = [], 0
            for i, text in enumerate(utf8_column(batch, "text")):
                for mini, content, start, n in _segments_of(text, unit):
                    parts.append((mini, content, start, n, i))
                    size += len(mini)
                if size > 200_000:
                    yield _segment_batch(parts, o, v, hot, n_salts)
                    parts, size = [], 0
            if parts:
                yield _segment_batch(parts, o, v, hot, n_salts)
    return run


def _segment_batch(parts, o, v, hot, n_salts):
    mini, content, start, n = (np.concatenate([p[k] for p in parts]) for k in range(4))
    doc = np.repeat([p[4] for p in parts], [len(p[0]) for p in parts])
    salt = np.where(_among(mini, hot), mix((o ^ v)[doc].view(np.uint64)) % np.uint64(n_salts), np.uint64(0))
    return pa.RecordBatch.from_arrays(
        [pa.array(mini), pa.array(salt.astype(np.int32)), pa.array(content), pa.array(o[doc]), pa.array(v[doc]),
         pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))],
        names=["mini", "salt", "content", "o", "v", "start", "n"])


def _among(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(table, x), len(table) - 1)
    return table[at] == x


def _frequent_minimisers(docs: DataFrame, unit: Unit) -> np.ndarray:
    """Minimisers that are frequent in at most about ``SAMPLE_DOCS`` documents, sorted."""
    total = docs.select("o").count()
    share = max(1, total // SAMPLE_DOCS)
    sample = docs.where(F.pmod(F.xxhash64("o", "v"), F.lit(share)) == 0)
    rows = sample.mapInArrow(_emit_segments(unit, np.empty(0, np.int64), 1), _SEGMENT)
    found = (rows.groupBy("mini").count().where(F.col("count") >= SAMPLE_HOT)
             .orderBy(F.desc("count"), "mini").limit(HOT_MAX).collect())
    return np.sort(np.array([r["mini"] for r in found], np.int64))


def _first_pass(unit: Unit, hot: np.ndarray):
    """Streams super-k-mers sorted by (mini, salt, content, o, v, start). Those of equal rows are one.
    Repeats go out as spans (``mini`` null); the first of each content goes out for step 2 once its
    minimiser has a second content. Only those of one content are held back."""
    def run(batches):
        last, held = None, None          # the last row's keys, its content's first place, whether its minimiser has several
        previous = None                  # the last row itself
        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            if not len(columns[0]):
                continue
            new = np.ones(len(columns[0]), bool)
            new[1:] = np.any([c[1:] != c[:-1] for c in columns[:6]], axis=0)
            new[0] = previous != [c[0] for c in columns]
            previous = [c[-1] for c in columns]
            if not new.any():
                continue
            mini, salt, content, o, v, start, n = (c[new] for c in columns)
            new_mini = np.empty(len(mini), bool)
            new_text = np.empty(len(mini), bool)
            new_mini[1:] = (mini[1:] != mini[:-1]) | (salt[1:] != salt[:-1])
            new_text[1:] = new_mini[1:] | (content[1:] != content[:-1])
            new_mini[0] = last is None or (mini[0], salt[0]) != last[0]
            new_text[0] = new_mini[0] or content[0] != last[1]
            text_at = np.maximum.accumulate(np.where(new_text, np.arange(len(mini)), -1))
            first = [np.where(text_at >= 0, x[text_at], x0) for x, x0 in zip((o, v, start), last[2] if last else (0, 0, 0))]
            if unit.by_document:
                repeat = o > first[0]
            else:
                repeat = (o != first[0]) | (v != first[1]) | (start != first[2])
            group = np.cumsum(new_mini) - new_mini[0]          # 0: the group running on from before, if any
            texts = np.bincount(group, weights=new_text)
            if not new_mini[0]:
                texts[0] += 2 if last[3] else 1
            several = (texts > 1)[group]
            keep = ~repeat & (several | _among(mini, hot))
            if held is not None and not new_mini[0] and texts[0] > 1:
                yield _first_batch(*held)
            if new_mini[0] or texts[0] > 1 or group[-1] > 0:
                held = None
            yield _first_batch(None, o[repeat], v[repeat], start[repeat], n[repeat])
            yield _first_batch(mini[keep], o[keep], v[keep], start[keep], n[keep])
            tail = ~repeat & ~keep & (group == group[-1])
            if tail.any():
                more = [x[tail] for x in (mini, o, v, start, n)]
                held = more if held is None else [np.concatenate(p) for p in zip(held, more)]
            last = ((mini[-1], salt[-1]), content[-1], [x[-1] for x in first], bool(several[-1]))
    return run


def _first_batch(mini, o, v, start, n):
    mini = pa.nulls(len(o), pa.int64()) if mini is None else pa.array(mini)
    return pa.RecordBatch.from_arrays([mini, pa.array(o), pa.array(v), pa.array(start), pa.array(n)],
                                      names=["mini", "o", "v", "start", "n"])


# ------------------------------------------------------------------ step 2: windows

_PACKED = "mini long, full boolean, o long, v long, start int, n int, packed binary"
_SPAN = "o long, v long, start int, n int"
_WINDOW = "a long, b long, o long, v long, start int"
_WALKED = "kind int, a long, b long, o long, v long, start int"


def _compare_windows(docs: DataFrame, reps: DataFrame, unit: Unit) -> DataFrame:
    """Repeated windows among super-k-mers that share a minimiser but differ."""
    full = reps.groupBy("mini").count().where(F.col("count") > BUCKET).select("mini", F.lit(True).alias("full"))
    reps = join_small(reps, stored(full, "full"), ["mini"]).withColumn("full", F.coalesce("full", F.lit(False)))
    per_doc = reps.groupBy("o", "v").agg(F.collect_list(F.struct("mini", "full", "start", "n")).alias("cuts"))
    texts = docs.groupBy("o", "v").agg(F.first("text").alias("text"))              # equal rows are one, before the shuffle
    packed = stored(texts.join(per_doc, ["o", "v"]).select("o", "v", "text", "cuts")
                    .mapInArrow(_pack(unit), _PACKED), "packed")
    cold = (packed.where(~F.col("full")).repartition("mini").sortWithinPartitions("mini")
            .mapInArrow(_sort_windows(unit), _SPAN))
    windows = packed.where("full").repartition("o", "v", "start").mapInArrow(_name_windows(unit), _WINDOW)
    place = ["o", "v", "start"]
    keys = ["a", "b", *place]
    ranged = stored(windows.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(_walk_windows(unit), _WALKED), "walked")
    # a class may run over several partitions: the first places of their first and last classes settle those left open
    least = ranged.where("kind = 2").groupBy("a", "b").agg(F.min("o").alias("o1"), F.min(F.struct(*place)).alias("first"))
    later = F.col("o") > F.col("o1") if unit.by_document else F.struct(*place) > F.col("first")
    settled = ranged.where("kind = 1").join(least, ["a", "b"]).where(later)
    return (cold.unionByName(ranged.where("kind = 0").select(*place, F.lit(1).alias("n")))
            .unionByName(settled.select(*place, F.lit(1).alias("n"))))


def _pack(unit: Unit):
    """Cuts the super-k-mers of each document out of its text."""
    def run(batches):
        for batch in batches:
            o, v = (batch.column(c).to_numpy() for c in ("o", "v"))
            cuts = batch.column("cuts").to_pylist()
            rows = [[] for _ in range(7)]
            for i, text in enumerate(utf8_column(batch, "text")):
                if unit.words:
                    begin, end = word_bounds(text)
                for c in cuts[i]:
                    a, b = c["start"], c["start"] + c["n"] + unit.width - 1
                    body = _packed_words(text, begin[a:b], end[a:b]) if unit.words else bytes(text[a:b])
                    for column, x in zip(rows, (c["mini"], c["full"], o[i], v[i], a, c["n"], body)):
                        column.append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(rows, (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(),
                                                       pa.int32(), pa.binary()))],
                names=["mini", "full", "o", "v", "start", "n", "packed"])
    return run


def _packed_words(text, begin, end) -> bytes:
    return b" ".join(bytes(text[s:e]) for s, e in zip(begin, end))


def _windows_of(batch: pa.RecordBatch, unit: Unit):
    """Every window of the packed super-k-mers: the index of its row, its place in the row and a
    pair of ranks, one of its first and one of its second part."""
    n = batch.column("n").to_numpy().astype(np.int64)
    packed = list(utf8_column(batch, "packed"))
    joined = (b" " if unit.words else b"").join(packed)
    h = _hashed(_elements(joined, unit), unit)
    begin = np.cumsum(n + unit.width - 1) - (n + unit.width - 1)
    row = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    at = begin[row] + place
    half = unit.width // 2
    front, back = (mix(gram_hashes(h, size)) for size in (half, unit.width - half))
    return row, place, front[at].view(np.int64), back[at + half].view(np.int64)


def _name_windows(unit: Unit):
    def run(batches):
        for whole in batches:
            for k in range(0, whole.num_rows, 2_000):
                batch = whole.slice(k, 2_000)
                row, place, a, b = _windows_of(batch, unit)
                o, v, start = (batch.column(c).to_numpy() for c in ("o", "v", "start"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array(b), pa.array(o[row]), pa.array(v[row]),
                     pa.array((start[row] + place).astype(np.int32))], names=["a", "b", "o", "v", "start"])
    return run


def _walk_windows(unit: Unit):
    """Streams windows sorted by (a, b, o, v, start). ``kind`` 0: repeats; 1: not repeats as far as this
    partition shows, though its first class may have begun before; 2: first places of its first and last class."""
    def run(batches):
        last, opening = None, True           # class and first place so far; still in the partition's first class
        for batch in batches:
            a, b, o, v, start = (c.to_numpy() for c in batch.columns)
            if not len(a):
                continue
            new = np.empty(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            new[0] = last is None or (a[0], b[0]) != last[:2]
            at = np.maximum.accumulate(np.where(new, np.arange(len(a)), -1))
            first = [np.where(at >= 0, x[at], x0) for x, x0 in zip((o, v, start), last[2:] if last else (0, 0, 0))]
            if unit.by_document:
                repeat = o > first[0]
            else:
                repeat = (o != first[0]) | (v != first[1]) | (start != first[2])
            is_open = (np.cumsum(new) <= (1 if last is None else 0)) if opening else np.zeros(len(a), bool)
            if last is None:
                yield _walked(2, *(x[:1] for x in (a, b, o, v, start)))
            yield _walked(0, *(x[repeat] for x in (a, b, o, v, start)))
            yield _walked(1, *(x[is_open & ~repeat] for x in (a, b, o, v, start)))
            opening = bool(is_open[-1])
            last = (a[-1], b[-1], *(x[-1] for x in first))
        if last is not None:
            yield _walked(2, *(np.array([x], t) for x, t in zip(last, (np.int64, np.int64, np.int64, np.int64, np.int32))))
    return run


def _walked(kind, *columns):
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(columns[0]), kind, np.int32)), *map(pa.array, columns)],
                                      names=["kind", "a", "b", "o", "v", "start"])


def _sort_windows(unit: Unit):
    """Buckets arrive one after the other; whole buckets are sorted together."""
    def run(batches):
        held = None
        for batch in batches:
            for k in range(0, batch.num_rows, 5_000):
                part = batch.slice(k, 5_000)
                held = part if held is None else pa.Table.from_batches([held, part]).combine_chunks().to_batches()[0]
                mini = held.column("mini").to_numpy()
                cut = int(np.searchsorted(mini, mini[-1]))      # the last bucket may go on
                if cut:
                    yield _repeats_in(held.slice(0, cut), unit)
                    held = held.slice(cut)
        if held is not None and held.num_rows:
            yield _repeats_in(held, unit)
    return run


def _repeats_in(batch: pa.RecordBatch, unit: Unit) -> pa.RecordBatch:
    row, place, a, b = _windows_of(batch, unit)
    mini, o, v, start = (batch.column(c).to_numpy() for c in ("mini", "o", "v", "start"))
    at = start[row] + place
    order = np.lexsort((at, v[row], o[row], b, a, mini[row]))
    s = [x[order] for x in (mini[row], a, b, o[row])]
    new = np.ones(len(order), bool)
    new[1:] = (s[0][1:] != s[0][:-1]) | (s[1][1:] != s[1][:-1]) | (s[2][1:] != s[2][:-1])
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    if unit.by_document:
        repeat = s[3] > o[row[first]]
    else:                                                        # a row given twice is one place
        repeat = (s[3] != o[row[first]]) | (v[row[order]] != v[row[first]]) | (at[order] != at[first])
    flag = np.zeros(len(order), bool)
    flag[order[repeat]] = True
    hit = np.flatnonzero(flag)                                   # back in row order: runs of neighbours
    run = np.ones(len(hit), bool)
    run[1:] = (np.diff(hit) != 1) | (row[hit[1:]] != row[hit[:-1]])
    begin = np.flatnonzero(run)
    length = np.diff(begin, append=len(hit)).astype(np.int32)
    r = row[hit[begin]]
    return pa.RecordBatch.from_arrays([pa.array(o[r]), pa.array(v[r]), pa.array(at[hit[begin]].astype(np.int32)),
                                       pa.array(length)], names=["o", "v", "start", "n"])


# ------------------------------------------------------------------ results

def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with the runs of repeated windows of each; null where there are none."""
    return docs.join(spans, ["o", "v"], "left")


def covered(spans, size: int, width: int) -> np.ndarray:
    """Mask of the elements covered by windows that start in ``spans`` (null: none)."""
    delta = np.zeros(size + 1, np.int32)
    if spans is not None and len(spans):
        begin = np.array([s["start"] for s in spans], np.int64)
        end = begin + np.array([s["n"] for s in spans], np.int64) + width - 1
        np.add.at(delta, begin, 1)
        np.add.at(delta, end, -1)
    return np.cumsum(delta[:size]) > 0


