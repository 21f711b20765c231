"""Operator 8, benchmark decontamination: finds passages of benchmark items in documents.

Method, with built-in functions only: windows of an item's size get a 64-bit SimHash of
their weighted 5-word shingles (weight: times the shingle occurs). The fingerprint is cut
into ``BLOCKS`` blocks; the index of the items holds every value within ``BLOCK_RADIUS``
bits of a block, so fingerprints within ``RADIUS`` bits always meet (of BLOCKS blocks, one
differs in at most RADIUS // BLOCKS bits). A window of similarity 0.75 lies 11 bits from
its item in the mean, ``RADIUS`` is four standard deviations beyond. Candidates are
verified by exact weighted Jaccard similarity.

A window as similar as that shares a number of shingles with the item that follows from the
sizes of both, in any order of its parts. So the windows that are fingerprinted are all those of an
item's size, at any start, that hold as many places of the item's shingles; no other window can
reach the similarity. Documents are first cut into stretches around shared places (``_stretches``)
and a stretch with fewer places than the smallest item needs ends there. The items' shingles
are compiled into the scan as a set, at most ``MAX_SHINGLES`` at once (more items: several
passes), and their index, of at most ``BLOCKS * 37`` rows per item of a pass, is broadcast.

Defined results: words are lower-cased; an item or document with fewer than five words is one
shingle; an empty item matches nothing; a document shorter than an item is compared as a
whole; null ids are reported as null; equal rows are reported equally; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.llm.storage import stored
from glossa.llm.texts import WORD_SPLIT

SHINGLE_WORDS = 5
PERCENT = 75
BLOCKS, BLOCK_BITS, BLOCK_RADIUS = 8, 8, 2
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1          # 23: what the blocks guarantee
MAX_SHINGLES = 20_000
#: bit patterns of a block with at most BLOCK_RADIUS bits set
FLIPS = [sum(1 << i for i in c) for r in range(BLOCK_RADIUS + 1) for c in combinations(range(BLOCK_BITS), r)]


def word_hashes(text: Column) -> Column:
    words = F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), WORD_SPLIT)
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def shingles(h: str, size: int) -> Column:
    """Hashes of the runs of ``size`` words, from the word hashes in column ``h``."""
    runs = F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, size)]))
    return F.slice(runs, F.lit(1), F.greatest(F.size(h) - (size - 1), F.lit(0)))


def with_simhash(df: DataFrame, hashes: str, name: str) -> DataFrame:
    """Adds the 64-bit SimHash of an array of 64-bit hashes: a bit is set if more than half of them
    have it. Sum g of sixteen counts the bits g, g + 16, g + 32 and g + 48 in 16-bit lanes of a long."""
    sums = (f"transform(sequence(0, 15), g -> aggregate({hashes}, 0L, "
            f"(acc, x) -> acc + (shiftrightunsigned(x, g) & 281479271743489L)))")
    # the sums are bound by a lambda, so that the optimiser cannot move them into the loop over the bits
    bits = (f"transform(array({sums}), s -> aggregate(sequence(0, 63), 0L, (acc, i) -> acc | if(2 * (shiftrightunsigned("
            f"s[i % 16], cast(16 * (i div 16) as int)) & 65535L) > size({hashes}), shiftleft(1L, i), 0L)))[0]")
    return df.withColumn(name, F.expr(bits))


def _blocks(df: DataFrame, fingerprint: str) -> DataFrame:
    """One row per block: its number ``i`` and its value ``b``."""
    value = F.expr(f"cast(shiftrightunsigned({fingerprint}, {BLOCK_BITS} * i) & {(1 << BLOCK_BITS) - 1}L as int)")
    return df.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1)))).withColumn("b", value)


def prepared_items(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, key, words, size, sh, fp``: a hash of id and text, word count, shingle size, shingle hashes and fingerprint."""
    d = items.select(F.col(id_col).alias("item_id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"), word_hashes(F.col(text_col)).alias("h")).withColumn("words", F.size("h"))
    d = d.where("words > 0").withColumn("size", F.least("words", F.lit(SHINGLE_WORDS)))
    sh = F.lit(None).cast("array<bigint>")
    for k in range(SHINGLE_WORDS, 0, -1):
        sh = F.when(F.col("size") == k, shingles("h", k)).otherwise(sh)
    return with_simhash(d.withColumn("sh", sh).drop("h"), "sh", "fp")


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 percent: int = PERCENT) -> DataFrame:
    """``id, item_id, start, n_words, hamming, similarity``: the most similar window per document (row) and
    item that reaches ``percent``; ``start`` counts words from 0."""
    bench = stored(prepared_items(items), "items")
    sizes = bench.groupBy("size").agg(F.sum(F.size("sh")).alias("n")).collect()      # at most five rows
    out = None
    for size, n in sorted((r["size"], r["n"]) for r in sizes):
        passes = -(-n // MAX_SHINGLES)
        for k in range(passes):
            part = bench.where((F.col("size") == size) & (F.pmod(F.hash("key"), F.lit(passes)) == k))
            found = _one_pass(docs, part, size, id_col, text_col, percent)
            out = found if out is None else out.unionByName(found)
    if out is None:
        kind = docs.schema[id_col].dataType.simpleString()
        item = items.schema["item_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame(
            [], f"{id_col} {kind}, item_id {item}, start int, n_words int, hamming int, similarity double")
    return out


def _needed(a: Column, b: Column, percent: int) -> Column:
    """Least number of shingles that sets of ``a`` and ``b`` shingles share at a similarity of ``percent``."""
    return F.greatest(F.lit(1), F.ceil(F.lit(percent) * (a + b) / F.lit(100 + percent))).cast("int")


def _stretches(docs: DataFrame, wanted: Column, size: int, widest: int, fewest: int, id_col: str, text_col: str) -> DataFrame:
    """``_id, _k, n, at, h, hits``: the parts of each document of ``n`` words that any window of a match lies in.
    A part begins at word ``at``, has word hashes ``h`` and shared shingles ``hits`` (place, hash), at least ``fewest``.
    Shared places farther apart than the ``widest`` item are in no common window."""
    d = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("_k"),
                    word_hashes(F.col(text_col)).alias("h")).withColumn("sh", shingles("h", size))
    d = d.withColumn("shared", F.array_intersect("sh", wanted))
    places = F.filter(F.transform("sh", lambda x, p: F.when(F.array_contains("shared", x), p)), lambda p: p.isNotNull())
    d = d.withColumn("places", F.when(F.size("shared") > 0, places))
    cuts = F.filter(F.transform("places", lambda p, i: F.when((i == 0) | (p - F.get("places", i - 1) > widest), i)),
                    lambda i: i.isNotNull())
    d = d.withColumn("cuts", F.when(F.size("places") >= fewest, cuts))
    runs = F.transform("cuts", lambda c, j: F.struct(c.alias("a"), F.coalesce(F.get("cuts", j + 1), F.size("places")).alias("b")))
    # explode_outer: the filter an inner explode infers would be pushed down and hash every text twice
    d = d.select("_id", "_k", "h", "sh", "places", F.explode_outer(F.filter(runs, lambda r: r["b"] - r["a"] >= fewest)).alias("r"))
    d = d.where("r is not null")
    first, last = F.get("places", F.col("r.a")), F.get("places", F.col("r.b") - 1)
    d = d.withColumn("at", F.greatest(first - widest, F.lit(0))).withColumn("to", F.least(last + widest + size, F.size("h")))
    inside = F.slice("places", F.col("r.a") + 1, F.col("r.b") - F.col("r.a"))
    hits = F.transform(inside, lambda p: F.struct(p.alias("p"), F.get("sh", p).alias("x")))
    return d.select("_id", "_k", F.size("h").alias("n"), "at", F.slice("h", F.col("at") + 1, F.col("to") - F.col("at")).alias("h"),
                    hits.alias("hits"))


def _one_pass(docs, part, size, id_col, text_col, percent) -> DataFrame:
    seeds = part.select("key", "words", F.size("sh").alias("m"), F.explode(F.array_distinct("sh")).alias("x"))
    wanted = part.select(F.explode("sh").alias("x")).agg(F.collect_set("x")).scalar()        # about MAX_SHINGLES hashes
    least, widest = part.agg(F.min(F.size("sh")), F.max("words")).first()
    if least is None:
        least, widest = 1, size
    fewest = max(1, -(-percent * least // 100))          # of a shorter document too: both >= percent / 100 * item
    d = stored(_stretches(docs, wanted, size, widest, fewest, id_col, text_col).dropDuplicates(["_id", "_k", "at"]), "stretches")
    near = d.select("_id", "_k", "n", "at", F.explode("hits").alias("s")).select("_id", "_k", "n", "at", "s.p", "s.x")
    near = near.join(F.broadcast(seeds), "x")                                       # at most one row per item shingle
    near = near.groupBy("_id", "_k", "n", "at", "key", "words", "m").agg(F.sort_array(F.collect_list("p")).alias("ps"))
    near = near.withColumn("n_words", F.least("words", "n")).withColumn("w", F.col("n_words") - (size - 1))
    near = near.withColumn("need", _needed(F.col("m"), F.col("w"), percent)).where(F.size("ps") >= F.col("need"))
    # windows that hold the places i .. i + need - 1
    low, high = F.get("ps", F.col("i") + F.col("need") - 1) - F.col("w") + 1, F.least(F.get("ps", F.col("i")), F.col("n") - F.col("n_words"))
    near = near.select("*", F.explode(F.sequence(F.lit(0), F.size("ps") - F.col("need"))).alias("i"))
    near = near.withColumn("low", F.greatest(low, F.lit(0))).withColumn("high", high).where("low <= high")
    near = near.select("_id", "_k", "at", "words", "n_words", F.explode(F.sequence("low", "high")).alias("start")).distinct()
    parts = d.select(F.col("_id").alias("_id2"), F.col("_k").alias("_k2"), F.col("at").alias("at2"), "h")
    d = near.join(parts, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_k") == F.col("_k2")) & (F.col("at") == F.col("at2")))
    d = d.select("_id", "_k", "words", "start", "n_words", F.slice("h", F.col("start") - F.col("at") + 1, F.col("n_words")).alias("w"))
    d = _blocks(stored(with_simhash(d.withColumn("ws", shingles("w", size)).drop("w"), "ws", "fp"), "windows"), "fp")
    flips = F.array(*[F.lit(x) for x in FLIPS])
    index = _blocks(part.select("key", "words", F.col("fp").alias("item_fp")), "item_fp")
    index = index.withColumn("b", F.explode(F.transform(flips, lambda f: f.bitwiseXOR(F.col("b")))))
    hamming = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    pairs = d.join(F.broadcast(index), ["words", "i", "b"]).withColumn("hamming", hamming).where(F.col("hamming") <= RADIUS)
    pairs = pairs.groupBy("_id", "_k", "key", "start", "n_words").agg(F.first("hamming").alias("hamming"), F.first("ws").alias("ws"))
    pairs = pairs.join(F.broadcast(part.select("key", "item_id", "sh").dropDuplicates(["key"])), "key")
    both = F.aggregate(F.array_distinct("sh"), F.lit(0), lambda acc, x: acc + F.least(
        F.size(F.filter("sh", lambda y: y == x)), F.size(F.filter("ws", lambda y: y == x))))
    pairs = pairs.withColumn("both", both).withColumn("all", F.size("sh") + F.size("ws") - F.col("both"))
    pairs = pairs.where(100 * F.col("both") >= percent * F.col("all")).withColumn("similarity", F.col("both") / F.col("all"))
    best = pairs.groupBy("_id", "_k", "item_id").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("s"), "n_words", "hamming")).alias("m"))
    return best.select(F.col("_id").alias(id_col), "item_id", (-F.col("m.s")).alias("start"), F.col("m.n_words").alias("n_words"),
                       F.col("m.hamming").alias("hamming"), F.round("m.similarity", 6).alias("similarity"))


def keep_clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item. A row is known by its id and a checksum of its text."""
    gone = contaminated(docs.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("x")).alias("key"),
                                    F.col(text_col).alias("text")), items, "key", "text").select("key.id", "key.x").distinct()
    rows = docs.select(F.struct(*docs.columns).alias("_r"), F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_x"))
    return rows.join(gone, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_x") == F.col("x")), "left_anti").select("_r.*")
