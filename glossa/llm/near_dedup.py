"""Operator 4, MinHash near-dedup: links documents with 5-word-shingle Jaccard of at least 0.75.

Method: circulant MinHash. A first permutation scatters the hashed shingles over
``UNIVERSE`` places; coordinate k of the signature is the minimum of a second permutation
shifted circularly by k. The coordinates of one shingle are thus a contiguous slice of the
second permutation, and a signature is a running minimum over slices. ``BANDS`` bands of
``BAND_ROWS`` coordinates give the buckets; a pair at 0.75 shares one with probability
1 - 8e-6. Every link is confirmed on the full sets.

Documents with equal sets are one node. In a bucket not all pairs are compared: first
each node with one pivot, then with the pivots of all its buckets, and then, where a
bucket still holds several components, the members across components, block by block inside
tasks. Pairs inside a component add nothing to it, so no link between components is left out.

Defined results: words are lower-cased in A-Z; with fewer than five words the whole sequence
is the one shingle; a null or wordless text has an empty set, is linked with nothing and kept;
a null id counts as larger than all ids (a component of null ids only has a null
``component_id`` and keeps its rows); rows that share an id are nodes by their own text;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.llm.components import components
from glossa.llm.repeats import NO_ID, keyed
from glossa.llm.segments import BASE, gram_hashes, mix
from glossa.llm.storage import stored
from glossa.llm.texts import utf8_column, word_hashes

SHINGLE_WORDS = 5
PERCENT = 75               # least Jaccard similarity of a link
BANDS, BAND_ROWS = 60, 6
UNIVERSE = 1 << 20
BLOCK = 512                # members of a bucket on each side of a comparison
SEED = 20_011
_U = np.uint64


def shingle_set(text) -> np.ndarray:
    """Sorted hashes of the distinct shingles of one text."""
    h = word_hashes(bytes(text).lower())                 # bytes.lower changes A-Z only
    if not len(h):
        return h
    size = min(SHINGLE_WORDS, len(h))
    return np.unique(mix(gram_hashes(h, size) + _U(size)))


class CirculantMinHash:
    """Signatures of ``n`` coordinates from two permutations of ``UNIVERSE`` places."""

    def __init__(self, n: int = BANDS * BAND_ROWS):
        second = np.random.default_rng(SEED).permutation(UNIVERSE).astype(np.uint32)
        self.slices = np.lib.stride_tricks.sliding_window_view(np.concatenate((second, second[:n])), n)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """Minimum over the shingles, 256 of them at a time."""
        place = (mix(shingles ^ _U(SEED)) >> _U(44)).astype(np.int64)        # first permutation: 20 bits
        place = np.unique(place) if len(place) > 4096 else place
        best = self.slices[place[:256]].min(axis=0)
        for k in range(256, len(place), 256):
            np.minimum(best, self.slices[place[k:k + 256]].min(axis=0), out=best)
        return best


def band_keys(signature: np.ndarray) -> np.ndarray:
    rows = signature.astype(np.uint64).reshape(BANDS, BAND_ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(BAND_ROWS):
        key = mix(key * _U(BASE) + rows[:, k])
    return key


_SIGNED = "id long, o long, v long, n long, s long, s2 long, bands array<long>"


def _sign(batches):
    hasher = CirculantMinHash()
    for whole in batches:
        for at in range(0, whole.num_rows, 1_000):
            batch = whole.slice(at, 1_000)
            n, s, s2, bands = [], [], [], []
            for text in utf8_column(batch, "text"):
                x = shingle_set(text)
                n.append(len(x))
                s.append(int(mix(x).sum(dtype=np.uint64)) if len(x) else 0)
                s2.append(int(mix(x ^ _U(BASE)).sum(dtype=np.uint64)) if len(x) else 0)
                bands.append(band_keys(hasher.signature(x)).view(np.int64) if len(x) else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("o"), batch.column("v"), pa.array(n, pa.int64()),
                 pa.array(np.array(s, np.uint64).view(np.int64)), pa.array(np.array(s2, np.uint64).view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(b) for b in bands]), pa.int32()),
                                          pa.array(np.concatenate(bands) if bands else np.empty(0, np.int64)))],
                names=["id", "o", "v", "n", "s", "s2", "bands"])


def _labelled(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, o, v, n, s, c`` per row of ``docs``: its key, size of its set, node and component."""
    rows = keyed(docs, id_col, text_col)
    signed = stored(rows.mapInArrow(_sign, _SIGNED), "signed")
    # one node per distinct set; s is its name, s2 keeps apart sets whose names collide
    one = F.min(F.struct("o", "v"))
    nodes = signed.where("n > 0").groupBy("s", "s2").agg(one.alias("at"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    buckets = stored(_shared_buckets(nodes), "buckets")
    wanted = buckets.select("s", "o", "v").distinct()
    text_of = rows.groupBy("o", "v").agg(F.first("text").alias("text"))              # equal rows are one, before the shuffle
    texts = stored(text_of.join(wanted, ["o", "v"]).select("s", "text"), "texts")
    labels = _link(buckets, texts)
    signed = signed.select("id", "o", "v", "n", "s").join(labels, "s", "left").withColumn("c", F.coalesce("c", "s"))
    return stored(signed, "labelled")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_shingles, component_id, kept`` and the key ``o, v`` of ``repeats.keyed``, per row of ``docs``."""
    signed = _labelled(docs, id_col, text_col)
    least = signed.where("n > 0").groupBy("c").agg(F.min("o").alias("least"))
    full = signed.where("n > 0").join(least, "c").unionByName(signed.where("n = 0").withColumn("least", F.col("o")))
    known = F.when(F.col("least") < NO_ID, F.col("least"))
    return full.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), known.alias("component_id"),
                       (F.col("o") == F.col("least")).alias("kept"), "o", "v")


def _shared_buckets(nodes: DataFrame) -> DataFrame:
    """``key, s, n, o, v``: members of the buckets that hold two nodes or more."""
    members = nodes.select("s", "n", "at.o", "at.v", F.explode("bands").alias("key"))
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    return members.join(shared, "key")


def _similar_size(a: Column, b: Column) -> Column:
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _link(buckets: DataFrame, texts: DataFrame) -> DataFrame:
    """``s, c``: the component of every node that has a link."""
    spark = buckets.sparkSession
    members = buckets.select("key", "s", "n")
    links = spark.createDataFrame([], "a long, b long")
    labels = spark.createDataFrame([], "s long, c long")
    for step in (_one_pivot, _all_pivots, _across(texts)):
        now = members.join(labels, "s", "left").select("key", "s", "n", F.coalesce("c", "s").alias("c"))
        found = _confirmed(step(now), texts)
        links = stored(links.unionByName(found), "links")
        labels = components(links)
    return labels


def _with_pivot(now: DataFrame) -> DataFrame:
    """Members whose component differs from that of their bucket's pivot (its smallest by component)."""
    pivot = now.groupBy("key").agg(F.min(F.struct("c", "s", "n")).alias("p"), F.max("c").alias("c2")).where("p.c < c2")
    d = now.join(pivot.select("key", "p"), "key").where(F.col("c") != F.col("p.c"))
    return d.where(_similar_size(F.col("n"), F.col("p.n")))


def _one_pivot(now: DataFrame) -> DataFrame:
    return _with_pivot(now).groupBy(F.col("s").alias("a")).agg(F.min("p.s").alias("b"))


def _all_pivots(now: DataFrame) -> DataFrame:
    return _with_pivot(now).select(F.col("s").alias("a"), F.col("p.s").alias("b")).distinct()


def _across(texts: DataFrame):
    """Pairs of one bucket in different components. Their sets meet in blocks of at most
    ``2 * BLOCK`` members and are compared there as a matrix product, so only similar pairs
    leave the task. Sets travel as 32-bit hashes, whose collisions can only add a pair; all
    pairs are confirmed afterwards."""
    def step(now: DataFrame) -> DataFrame:
        open_ = now.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("c").alias("c1"), F.max("c").alias("c2")).where("c1 < c2")
        open_ = stored(now.join(open_.select("key", "m"), "key"), "open")
        sets = texts.join(open_.select("s").distinct(), "s", "left_semi").mapInArrow(_short_sets, "s long, x binary")
        blocks = F.ceil(F.col("m") / F.lit(BLOCK)).cast("int")
        d = open_.withColumn("own", F.pmod(F.xxhash64("s"), blocks).cast("int"))
        d = d.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        d = d.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "s", "c")
        d = d.join(sets, "s").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "own", "s")
        return d.select("key", "i", "j", "own", "s", "c", "x").mapInArrow(_compare_blocks, "a long, b long").distinct()
    return step


def _short_sets(batches):
    for whole in batches:
        for k in range(0, whole.num_rows, 1_000):
            batch = whole.slice(k, 1_000)
            x = [np.unique((shingle_set(t) >> _U(32)).astype(np.uint32)).tobytes() for t in utf8_column(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("s"), pa.array(x, pa.binary())], names=["s", "x"])


def _compare_blocks(batches):
    """Rows arrive block by block; a block is compared when its last row is there."""
    group, rows = None, []
    for batch in batches:
        key, i, j, own, s, c = (batch.column(n).to_numpy() for n in ("key", "i", "j", "own", "s", "c"))
        for r, x in enumerate(utf8_column(batch, "x")):
            g = (key[r], i[r], j[r])
            if g != group:
                if rows:
                    yield _similar_pairs(rows, group)
                group, rows = g, []
            rows.append((own[r], s[r], c[r], np.frombuffer(bytes(x), np.uint32)))
    if rows:
        yield _similar_pairs(rows, group)


def _similar_pairs(rows, group) -> pa.RecordBatch:
    own, s, c = (np.array([r[k] for r in rows], np.int64) for k in range(3))
    size = np.array([len(r[3]) for r in rows], np.int64)
    member = np.repeat(np.arange(len(rows)), size)
    _, place, often = np.unique(np.concatenate([r[3] for r in rows]), return_inverse=True, return_counts=True)
    shared = often[place] > 1                               # a shingle of one member adds to no intersection
    column = (np.cumsum(often > 1) - 1)[place[shared]]
    member = member[shared]
    order = np.argsort(column, kind="stable")
    column, member = column[order], member[order]
    both = np.zeros((len(rows), len(rows)), np.float32)
    for k in range(0, int(column[-1]) + 1 if len(column) else 0, 2_048):
        a, b = np.searchsorted(column, (k, k + 2_048))
        part = np.zeros((len(rows), 2_048), np.float32)
        part[member[a:b], column[a:b] - k] = 1
        both += part @ part.T
    union = size[:, None] + size[None, :] - both
    hit = np.triu(100 * both >= PERCENT * union, 1) & (c[:, None] != c[None, :])
    if group[1] != group[2]:                                # pairs inside a block belong to its own group
        hit &= own[:, None] != own[None, :]
    x, y = np.nonzero(hit)
    return pa.RecordBatch.from_arrays([pa.array(s[x]), pa.array(s[y])], names=["a", "b"])


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    a = texts.select(F.col("s").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("s").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b").mapInArrow(_compare, "a long, b long")


def _compare(batches):
    last, known = None, None
    for batch in batches:
        a, b = (batch.column(c).to_numpy() for c in ("a", "b"))
        same = np.zeros(len(a), bool)
        for i, (x, y) in enumerate(zip(utf8_column(batch, "text_a"), utf8_column(batch, "text_b"))):
            if last != b[i]:                              # sorted by b: a pivot's set is made once
                last, known = b[i], shingle_set(y)
            mine = shingle_set(x)
            both = len(np.intersect1d(mine, known, assume_unique=True))
            same[i] = 100 * both >= PERCENT * (len(mine) + len(known) - both)
        yield pa.RecordBatch.from_arrays([pa.array(a[same]), pa.array(b[same])], names=["a", "b"])


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without those that a near-duplicate with a smaller id makes superfluous."""
    gone = near_duplicates(docs, id_col, text_col).where(~F.col("kept")).select("o", "v").distinct()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.struct(*docs.columns).alias("_r"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("o"),
                       F.xxhash64(text).alias("v"))
    return rows.join(gone, ["o", "v"], "left_anti").select("_r.*")


def keep_single(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component one row of the smallest (id, text
    checksum) stays, also if rows repeat, share an id or have none. Rows without words all stay."""
    marked = _labelled(docs, id_col, text_col).where("n > 0").groupBy("c", "o", "v").agg(F.count(F.lit(1)).alias("m"))
    marked = stored(marked, "marked")
    least = marked.groupBy("c").agg(F.min(F.struct("o", "v")).alias("at"))
    # a row's state: null if it is alone, 1 if it is the first of rows that repeat, 0 if it goes
    stays = (F.col("o") == F.col("at.o")) & (F.col("v") == F.col("at.v"))
    state = marked.join(least, "c").withColumn("state", F.when(~stays, 0).when(F.col("m") > 1, 1)).where("state is not null")
    state = stored(state.groupBy("o", "v").agg(F.min("state").alias("state")), "state")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.struct(*docs.columns).alias("_r"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("o"),
                       F.xxhash64(text).alias("v"))
    alone = rows.join(state, ["o", "v"], "left_anti").select("_r.*")
    # a partial minimum in every task first: equal rows are no hot key
    first = rows.join(state.where("state = 1"), ["o", "v"], "left_semi").groupBy("o", "v").agg(F.min("_r").alias("_r"))
    return alone.unionByName(first.select("_r.*"))


def digest(result: DataFrame) -> DataFrame:
    """The columns of the query."""
    return result.select("doc_id", "n_shingles", "component_id", "kept")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: DuckDB SQL of the query for tables whose ids are unique and known
ORACLE_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
starts AS (SELECT doc_id, ws, least({SHINGLE_WORDS}, len(ws)) AS m, unnest(range(1, len(ws) - least({SHINGLE_WORDS}, len(ws)) + 2)) AS i
  FROM w WHERE len(ws) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + m - 1), ' ') AS x FROM starts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS k FROM shingles p JOIN shingles q ON p.x = q.x AND p.doc_id < q.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b WHERE 100 * k >= {PERCENT} * (s.n + t.n - k)),
steps AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sizes UNION SELECT r.a, s.b FROM reach r JOIN steps s ON r.b = s.a),
least_id AS (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, coalesce(c, w.doc_id) AS component_id, coalesce(c, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN sizes USING (doc_id) LEFT JOIN least_id USING (doc_id)"""
