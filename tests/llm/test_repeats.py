"""Operators 1 and 6 against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from glossa.llm import near_dedup, quality_bayes, repeats, substring_dedup, suffix_dedup

SCHEMA = "doc_id long, text string, kept string, spans int"


def brute_words(rows, width=13):
    first, texts = {}, []
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        texts.append((i, words))
        for p in range(len(words) - width + 1):
            w = tuple(words[p:p + width])
            first[w] = min(first.get(w, i), i)
    out = []
    for i, words in texts:
        gone = set()
        for p in range(len(words) - width + 1):
            if first[tuple(words[p:p + width])] < i:
                gone |= set(range(p, p + width))
        kept = " ".join(w for p, w in enumerate(words) if p not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def brute_bytes(rows, width=100):
    seen, out = set(), []
    for i, text in sorted(rows):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - width + 1):
            w = b[p:p + width]
            if w in seen:
                gone[p:p + width] = b"\1" * width
            seen.add(w)
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus():
    rnd = random.Random(5)
    vocab = ["the", "of", "and", "a", "é", "ñandú"] + ["w%d" % i for i in range(300)]
    passage = [rnd.choice(vocab) for _ in range(60)]
    rows = []
    for i in range(120):
        words = [rnd.choice(vocab) for _ in range(rnd.choice([0, 5, 13, 40, 200]))]
        if i % 3 == 0:                                   # a hot passage at random places
            at = rnd.randint(0, len(words))
            words[at:at] = passage[rnd.randint(0, 20):rnd.randint(30, 60)]
        if i % 10 == 4 and rows:                         # exact and near copies
            words = (rows[rnd.randrange(len(rows))][1] or "").split()
            if words and i % 20 == 4:
                words[rnd.randrange(len(words))] = "edited"
        rows.append((i, rnd.choice([" ", "  ", "\n"]).join(words)))
    rows += [(500, None), (501, ""), (502, " \t\n"), (503, "again " * 400), (504, "x" * 700), (505, "the of and a " * 900)]
    return rows


@pytest.fixture(params=["plain", "tight"])
def limits(request, monkeypatch):
    """``tight``: every path for skew and long texts is taken."""
    if request.param == "tight":
        monkeypatch.setattr(repeats, "BUCKET", 3)
        monkeypatch.setattr(repeats, "SAMPLE_HOT", 4)
        monkeypatch.setattr(repeats, "SLICE", 64)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], SCHEMA).repartition(5)


def test_words_match_brute_force(spark, limits):
    rows = corpus()
    got = substring_dedup.digest(substring_dedup.dedup_substrings(frame(spark, rows))).collect()
    assert sorted(map(tuple, got)) == brute_words(rows)


def test_bytes_match_brute_force(spark, limits):
    rows = corpus()
    got = suffix_dedup.digest(suffix_dedup.dedup_suffixes(frame(spark, rows))).collect()
    assert sorted(map(tuple, got)) == brute_bytes(rows)


def test_repeated_rows_and_null_ids(spark):
    text = " ".join("w%d" % i for i in range(40))
    rows = [(1, text), (1, text), (None, text), (None, None), (2, "short")]
    words = substring_dedup.dedup_substrings(frame(spark, rows)).collect()
    assert sorted((r.doc_id or 9, r.n_removed) for r in words) == [(1, 0), (1, 0), (2, 0), (9, 0), (9, 40)]
    cut = suffix_dedup.dedup_suffixes(frame(spark, rows)).collect()
    assert sorted((r.doc_id or 9, r.n_removed) for r in cut) == [(1, 0), (1, 0), (2, 0), (9, 0), (9, len(text))]


def test_texts_of_equal_32_bit_checksum_are_told_apart(spark):
    made = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(39)), lambda j: F.concat(F.lit("u"), F.col("id"), F.lit("x"), j)))
    texts = spark.range(300_000).select(made.alias("text"), F.hash(made).alias("h"))
    a, b = texts.groupBy("h").agg(F.collect_list("text").alias("t")).where(F.size("t") > 1).orderBy("h").first().t[:2]
    rows = [(1, a), (None, a), (None, b)]
    clean = lambda out: [r.kept for r in out.collect() if r.n_removed == 0]
    assert sorted(clean(substring_dedup.dedup_substrings(frame(spark, rows)))) == sorted([a, b])
    assert sorted(bytes(x).decode() for x in clean(suffix_dedup.dedup_suffixes(frame(spark, rows)))) == sorted([a, b])
    assert sorted(r.text for r in near_dedup.keep_one(frame(spark, rows)).collect()) == sorted([a, b])
    marks = quality_bayes.quality_scores(frame(spark, rows), None, host_col="kept", path_col="kept")
    assert marks.select("v").distinct().count() == 2


def test_empty_table(spark):
    assert substring_dedup.dedup_substrings(frame(spark, [])).collect() == []
    assert suffix_dedup.dedup_suffixes(frame(spark, [])).collect() == []
