"""Operator 11, phrase collocation mining: prefix-free parsing.

Method:

1. *Parse.* A word starts a trigger if the hash of the four words from it on is divisible by
   ``SPACING``. A chunk runs from one trigger to the end of the next, so neighbours overlap by
   exactly these four words, and equal passages give equal chunks wherever they stand. The
   distinct chunks of each language with their frequencies are the dictionary: one grouped count,
   stored. Everything after reads the dictionary, not the texts.
2. *Count.* A phrase of up to five words belongs to the chunk in which it starts before the
   closing trigger, so an overlap counts once; each chunk's phrases count with its frequency.
   Words first, then pairs of words that both reach ``support``, then longer phrases whose pairs
   all do: a phrase is never more frequent than its parts, so nothing that can pass is left out.
   Which words and pairs pass travels as a bitmap of fixed size (``BITMAP_BITS``) over hashes.
   A collision there lets a phrase be counted in vain; what is summed across batches are exact strings.
   Inside a batch of some 800,000 words equal phrases are found by 64-bit keys (chance of an error 2e-8 a batch).
3. *Score.* Every cut joins the exact counts of both parts; arithmetic is in 38-digit decimals.

Phrases are summed inside each task before the shuffle. The keys of joins are salted, as one
common word begins many phrases. Ranks take the best rows of 64 parts of each language first.

Defined results: a null text is empty, a null language is ``und`` (one with a row that says
``und``); empty tables and texts give no rows; repeated rows count each; ids and other columns are
ignored. Pieces end at ``[.,;:!?\\x0A-\\x0D]``; words hold anything but blanks and tabs. A language
without candidates has no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossa.llm.segments import BASE, gram_hashes, mix
from glossa.llm.storage import join_small, stored
from glossa.llm.texts import hashes_between, utf8_column, word_bounds

# --- fixed values of the contract ------------------------------------------------
LONGEST = 5
SUPPORT = 100
TOP = 2_000
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
# ---------------------------------------------------------------------------------
TRIGGER = LONGEST - 1       # words of a trigger, and of the overlap
SPACING = 16                # mean words between triggers
BITMAP_BITS = 1 << 26       # 8 MB: what a task holds of the frequent words or pairs
_SLICE_BITS = 1 << 15       # of a bitmap, in one row (the size that Spark's bitmap functions use)
_CHUNKS = 40_000            # chunks whose phrases are summed at once
_SALTS = 8
_CLEAN = bytes(32 if b == 9 else 10 if b in PIECE_ENDS else b + 32 if 65 <= b <= 90 else b for b in range(256))


def chunks(text: bytes) -> list[tuple[bytes, bool]]:
    """The chunks of a text and whether another follows (its last four words belong to that one)."""
    text = bytes(text).translate(_CLEAN)
    starts, ends = word_bounds(text)
    if not len(starts):
        return []
    at = []
    if len(starts) > TRIGGER:
        g = mix(gram_hashes(hashes_between(text, starts, ends), TRIGGER))
        at = np.flatnonzero(g[1:] % np.uint64(SPACING) == 0) + 1
        at = at[at + TRIGGER < len(starts)]                     # a trigger at the very end would open an empty chunk
    first = [0, *starts[at].tolist()] if len(at) else [0]
    last = [*ends[at + TRIGGER - 1].tolist(), len(text)] if len(at) else [len(text)]
    return [(text[a:b], k + 1 < len(first)) for k, (a, b) in enumerate(zip(first, last))]


def _parse(batches):
    for whole in batches:
        for start in range(0, whole.num_rows, 500):
            batch = whole.slice(start, 500)
            rows, texts, more = [], [], []
            for i, text in enumerate(utf8_column(batch, "text")):
                for chunk, follows in chunks(text):
                    rows.append(i)
                    texts.append(chunk)
                    more.append(follows)
            yield pa.RecordBatch.from_arrays([batch.column("lang").take(pa.array(rows, pa.int32())), pa.array(texts, pa.binary()),
                                              pa.array(more, pa.bool_())], names=["lang", "chunk", "more"])


def dictionary(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, chunk, more, freq``: the distinct chunks and how often they occur."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    parsed = rows.mapInArrow(_parse, "lang string, chunk binary, more boolean")
    return stored(parsed.groupBy("lang", "chunk", "more").agg(F.count(F.lit(1)).alias("freq")), "chunks")


class Positions:
    """The words of many chunks of one language as arrays, in order: the hash ``key`` of a word, its
    bytes ``first`` to ``last`` of ``text``, whether phrases are counted from it (``start``), whether
    the following word is in the same piece (``next``) and the frequency of its chunk (``weight``)."""

    def __init__(self, chunk_list: list, more: np.ndarray, freq: np.ndarray):
        text = b"\x0b".join(chunk_list)
        while b"  " in text:
            text = text.replace(b"  ", b" ")
        raw = np.frombuffer(text, np.uint8)
        self.text = text
        self.first, self.last = word_bounds(text)
        self.key = hashes_between(text, self.first, self.last)
        chunk = np.cumsum(raw == 11, dtype=np.int32)[self.first]
        piece = np.cumsum((raw == 10) | (raw == 11), dtype=np.int32)[self.first]
        behind = np.cumsum(np.bincount(chunk, minlength=len(chunk_list)))[chunk] - 1 - np.arange(len(chunk))
        self.start = ~(more[chunk] & (behind < TRIGGER))
        self.next = np.append(piece[1:] == piece[:-1], False)[:len(chunk)]
        self.weight = freq[chunk]

    def summed(self, at: np.ndarray, key: np.ndarray, size: int):
        """Distinct phrases of ``size`` words from the places ``at`` and their summed weights (exact below 2**53)."""
        found, where, place = np.unique(key, return_index=True, return_inverse=True)
        sums = np.bincount(place, weights=self.weight[at], minlength=len(found)).astype(np.int64)
        at = at[where]
        text = self.text
        return [text[a:b] for a, b in zip(self.first[at].tolist(), self.last[at + size - 1].tolist())], sums


def _joined(key: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Keys of phrases that are one word longer."""
    return mix(key * np.uint64(BASE) + after)


def _fold(lang: str) -> np.uint64:
    from xxhash import xxh64_intdigest
    return np.uint64(xxh64_intdigest(lang.encode()))


def _sum_phrases(phrases):
    """A task: ``phrases(positions, fold)`` yields phrases and sums for some ten thousand chunks of one language."""
    def run(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, _CHUNKS):
                batch = whole.slice(start, _CHUNKS)
                langs = batch.column("lang").dictionary_encode()
                more = batch.column("more").to_numpy(zero_copy_only=False)
                freq = batch.column("freq").to_numpy()
                number = langs.indices.to_numpy()
                for i, lang in enumerate(langs.dictionary.to_pylist()):
                    rows = np.flatnonzero(number == i)
                    fold = _fold(lang)
                    where = Positions(batch.column("chunk").take(pa.array(rows)).to_pylist(), more[rows], freq[rows])
                    for names, sums in phrases(where, fold):
                        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(names), pa.string()), pa.array(names, pa.binary()),
                                                          pa.array(sums, pa.int64())], names=["lang", "phrase", "f"])
    return run


def _counted(chunks_table: DataFrame, phrases) -> DataFrame:
    return (chunks_table.mapInArrow(_sum_phrases(phrases), "lang string, phrase binary, f long")
            .groupBy("lang", "phrase").agg(F.sum("f").alias("f")))


def _keys(size: int):
    """Keys of phrases of ``size`` words, from their strings: keys are not shuffled with the counts."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                text = b"\n".join(batch.column("phrase").to_pylist())
                word = hashes_between(text, *word_bounds(text)).reshape(-1, size)
                key = word[:, 0]
                for k in range(1, size):
                    key = _joined(key, word[:, k])
                langs = batch.column("lang").dictionary_encode()
                fold = np.array([_fold(lang) for lang in langs.dictionary.to_pylist()], np.uint64)[langs.indices.to_numpy()]
                yield pa.RecordBatch.from_arrays([pa.array((key ^ fold).view(np.int64))], names=["h"])
    return run


class Passing:
    """The keys of the phrases that reach the support, as a bitmap: ``BITMAP_BITS / 8`` bytes, whatever their number."""

    def __init__(self, counted: DataFrame, size: int):
        bit = F.pmod("h", F.lit(BITMAP_BITS))
        slices = (counted.select("lang", "phrase").mapInArrow(_keys(size), "h long").select(F.floor(bit / _SLICE_BITS).alias("k"), (bit % _SLICE_BITS).alias("p")).groupBy("k")
                  .agg(F.bitmap_construct_agg("p").alias("bits")).collect())              # at most BITMAP_BITS / 8 bytes
        whole = bytearray(BITMAP_BITS // 8)
        for r in slices:
            at = r["k"] * _SLICE_BITS // 8
            whole[at:at + len(r["bits"])] = r["bits"]
        self.held = counted.sparkSession.sparkContext.broadcast(bytes(whole))

    def __call__(self, key: np.ndarray, fold: np.uint64) -> np.ndarray:
        bit = (key ^ fold) & np.uint64(BITMAP_BITS - 1)
        bits = np.frombuffer(self.held.value, np.uint8)
        return (bits[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def phrase_counts(chunks_table: DataFrame, support: int = SUPPORT) -> tuple[DataFrame, DataFrame]:
    """Phrases of one to five words that occur ``support`` times (``lang, phrase, k, f``), and ``lang, n``."""
    def single(where, fold):
        at = np.flatnonzero(where.start)
        yield where.summed(at, where.key[at], 1)
    words = stored(_counted(chunks_table, single), "words")
    totals = stored(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    words = words.where(F.col("f") >= support)
    known = Passing(words, 1)

    def both(where, fold):
        good = known(where.key, fold)
        return np.flatnonzero(good[:-1] & good[1:] & where.next[:-1])

    def pairs(where, fold):
        at = both(where, fold)
        at = at[where.start[at]]
        yield where.summed(at, _joined(where.key[at], where.key[at + 1]), 2)
    two = stored(_counted(chunks_table, pairs).where(F.col("f") >= support), "pairs")
    linked = Passing(two, 2)

    def longer(where, fold):
        at = both(where, fold)
        key = _joined(where.key[at], where.key[at + 1])
        passes = linked(key, fold)
        at, key = at[passes], key[passes]
        joint = np.zeros(len(where.key) + LONGEST, bool)       # a pair that passes begins here
        joint[at] = True
        begins = where.start[at]
        at, key = at[begins], key[begins]
        for k in range(3, LONGEST + 1):
            more = joint[at + k - 2]
            at = at[more]
            key = _joined(key[more], where.key[at + k - 1])
            yield where.summed(at, key, k)
    more = _counted(chunks_table, longer).where(F.col("f") >= support)
    found = [t.select("lang", F.col("phrase").cast("string").alias("phrase"), "f") for t in (words, two, more)]
    every = found[0].unionByName(found[1]).unionByName(found[2])
    return stored(every.withColumn("k", F.size(F.split("phrase", " "))), "phrases"), totals


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` and the cut (words of the first part) of each language's best phrases."""
    phrases, totals = phrase_counts(dictionary(docs, text_col, lang_col), support)
    candidates = phrases.where("k >= 2").withColumnRenamed("f", "a")
    # a phrase with a longer one of the same count also has one that is longer by one word
    inside = candidates.where("k > 2").select("lang", "a", F.explode(F.array(
        F.expr("substring_index(phrase, ' ', k - 1)"), F.expr("substring_index(phrase, ' ', 1 - k)"))).alias("phrase")).distinct()
    candidates = candidates.join(inside, ["lang", "phrase", "a"], "left_anti")
    word = F.split("phrase", " ")
    cuts = (candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
            .withColumn("first", F.array_join(F.slice(word, F.lit(1), F.col("cut")), " "))
            .withColumn("rest", F.array_join(F.slice(word, F.col("cut") + 1, F.col("k") - F.col("cut")), " "))
            .withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS))))
    part = phrases.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))).withColumn("salt", F.col("salt").cast("long"))
    cuts = (cuts.join(part.select("lang", "salt", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "salt", "first"])
            .join(part.select("lang", "salt", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "salt", "rest"]))
    cuts = join_small(cuts, totals, ["lang"])
    wide = {c: F.col(c).cast("decimal(19,0)") for c in "alrn"}
    cuts = cuts.withColumn("above", wide["a"] * wide["n"] * F.lit(1000).cast("decimal(4,0)")).withColumn("below", wide["l"] * wide["r"])
    cuts = cuts.withColumn("score", F.expr("above div below"))
    best = (cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("b"))
            .select("lang", "phrase", "a", "n", "b.*"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    best = best.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return best.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut")


def digest(result: DataFrame) -> DataFrame:
    """The columns of the query."""
    return result.drop("cut")


#: the same results by counting every phrase of every text
ORACLE_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (SELECT lang, w[i:i + k - 1] AS g, k FROM starts, range(1, {LONGEST + 1}) t(k) WHERE i + k - 1 <= len(w)),
n AS (SELECT lang, count(*) AS n FROM grams WHERE k = 1 GROUP BY lang),
f AS (SELECT lang, array_to_string(g, ' ') AS phrase, g, k, count(*) AS f FROM grams GROUP BY lang, g, k HAVING count(*) >= {SUPPORT}),
inner_parts AS (SELECT lang, f AS a, array_to_string(g[s:s + m - 1], ' ') AS phrase
                FROM f, range(1, {LONGEST}) t(s), range(2, {LONGEST}) u(m) WHERE k > 2 AND m < k AND s + m - 1 <= k),
c AS (SELECT * FROM f WHERE k >= 2 AND NOT EXISTS (
        SELECT 1 FROM inner_parts p WHERE p.lang = f.lang AND p.phrase = f.phrase AND 100 * p.a >= 100 * f.f)),
cuts AS (SELECT c.lang, c.phrase, c.f AS a, n.n, l.f AS l, r.f AS r, cut,
                CAST((1000::HUGEINT * c.f * n.n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
         FROM c, range(1, {LONGEST}) t(cut), f l, f r, n
         WHERE cut < c.k AND n.lang = c.lang AND l.lang = c.lang AND r.lang = c.lang
           AND l.phrase = array_to_string(c.g[1:cut], ' ') AND r.phrase = array_to_string(c.g[cut + 1:c.k], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score FROM ranked WHERE rank <= {TOP}
"""
