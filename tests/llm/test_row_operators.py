"""Operators 2, 3, 5, 9 and 10 against brute force, exact round trips and edge rows."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from glossa.llm import mixing, quality_rules, sharding, token_counts, warc

EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (None, "no id"), (6, "the cat sat on the mat " * 30), (6, "the cat sat on the mat " * 30),
         (7, "x" * 20_000), (8, "a b c\na b c\na b c d # *"), (9, "ñandú é " * 40)]


def frame(spark, rows=EDGES):
    return spark.createDataFrame([(i, t, "s", 5) for i, t in rows], "doc_id long, text string, kept string, shard int").repartition(3)


# ---------------------------------------------------------------- 2

def greedy(word: bytes, tokens: set) -> int:
    n = 0
    while word:
        size = max(k for k in range(1, min(len(word), 40) + 1) if word[:k] in tokens)
        word, n = word[size:], n + 1
    return n


def test_automaton_equals_greedy_matching():
    rnd = random.Random(3)
    tokens = [bytes([b]) for b in range(256)] + [bytes(rnd.choices(b"abc ", k=rnd.randint(2, 7))) for _ in range(300)]
    a = token_counts.Automaton(tokens)
    for _ in range(3_000):
        word = bytes(rnd.choices(b"abc d", k=rnd.randint(0, 30)))
        assert a.pieces(word) == greedy(word, set(tokens))
    with pytest.raises(ValueError):
        token_counts.Automaton([b"a"])


def test_token_counts_with_a_public_vocabulary(spark, tmp_path):
    tokens = {base64.b64decode(x.split()[0]) for x in open(token_counts.VOCABULARY, "rb")}
    got = {(r.doc_id, r.n_words, r.n_tokens) for r in token_counts.token_counts(frame(spark)).collect()}
    want = set()
    for i, t in EDGES:
        words = (t or "").encode().split()
        want.add((i, len(words), sum(greedy(b" " + w, tokens) for w in words)))
    assert got == want
    assert token_counts.token_counts(frame(spark, [])).count() == 0


# ---------------------------------------------------------------- 3

def test_poisson_has_its_mean_and_variance(spark):
    d = spark.range(20_000)
    for rate in (0.3, 2.0, 30.0):
        m, v = d.select(mixing.poisson(F.lit(rate), 1, F.col("id")).alias("n")).agg(F.avg("n"), F.var_samp("n")).first()
        assert abs(m - rate) < 5 * (rate / 20_000) ** 0.5 and abs(v / rate - 1) < 0.1


def test_mixing(spark):
    rows = [(i, "w " * (10 if i % 3 else 40), f"s{i % 3}" if i % 3 != 2 else None, i) for i in range(3_000)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, copy long")
    out = mixing.mix(d, weights={"s0": 1.0, "s1": 3.0})
    assert out.columns == ["doc_id", "text", "source", "copy", "rate", "mix_key"]
    words = dict(out.groupBy("source").agg(F.sum(F.size(F.split(F.trim("text"), " ")))).collect())
    assert set(words) == {"s0", "s1"} and abs(words["s1"] / words["s0"] - 3) < 0.4
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, mixing.mix(d.repartition(7), weights={"s0": 1.0, "s1": 3.0}).collect()))
    keys = [r.mix_key for r in out.select("mix_key").collect()]
    assert keys == sorted(keys)
    by_size = mixing.source_rates(d)                                # every source, its null one too
    assert {r.source: r.n_docs for r in by_size.collect()} == {"s0": 1000, "s1": 1000, None: 1000}
    assert abs(by_size.agg(F.sum(F.col("rate") * F.col("n_words")) / F.sum("n_words")).first()[0] - 1) < 1e-9
    edges = frame(spark).withColumn("source", F.lit("a"))
    assert mixing.mix(edges, epochs=50.0).select("doc_id").distinct().count() == 9
    assert mixing.mix(edges.where("doc_id < 0")).count() == 0


# ---------------------------------------------------------------- 5

def brute_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    often = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if often[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    return (len(words), sum(map(len, words)), sum(c in quality_rules.SYMBOLS for c in text), len(lines) - len(set(lines)),
            len(covered), len(words) < 50 or 100 * len(covered) > 50 * len(words))


def test_quality_rules_match_brute_force(spark):
    rnd = random.Random(8)
    rows = EDGES + [(100 + i, " ".join(rnd.choice(["a", "b", "c", "the", "of\n", "#x|"]) for _ in range(rnd.randint(0, 200)))) for i in range(60)]
    got = quality_rules.quality_rules(frame(spark, rows))
    key = lambda r: (r[0] or 0, r[1:])
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                   for r in got.collect()), key=key) == sorted(((i, *brute_rules(t)) for i, t in rows), key=key)
    assert got.where("base_failed and kept").count() == 0
    plan = quality_rules.quality_rules(spark.range(9).selectExpr("id as doc_id", "string(id) as text"))
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Exchange", "Python", "Arrow", "Generate", "Join"))


def test_rules_reject_junk_and_keep_prose(spark):
    prose = " ".join(f"the cat{i} of house{i} sat{i} in a garden{i}" for i in range(12))
    rows = [(1, prose), (2, " ".join(w + "###" for w in prose.split())), (3, prose.upper()), (4, "\n".join(prose.split()))]
    rules = {r.doc_id: (r.kept, r.failed_rules) for r in quality_rules.quality_rules(frame(spark, rows)).collect()}
    assert rules == {1: (True, []), 2: (False, ["symbols_per_word", "stop_word_share"]), 3: (False, ["stop_word_share"]),
                     4: (False, ["words_per_line"])}


# ---------------------------------------------------------------- 9

PAGES = [(5, "http://a/é x\r\n", "<p>one</p>"), (3, None, "<p>one</p>"), (9, "http://b", None), (8, "http://c", ""), (4, "u", "<p>ñ</p>" * 5_000),
         (3, "again", "<p>one</p>"), (None, "no id", "<p>one</p>"), (None, "n", "only here")]


def test_warc_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 200)
    d = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("id", F.lit("clash")).repartition(3)
    got = warc.digest(warc.archive_pages(spark, d)).collect()
    first = {}
    for i, _, h in PAGES:
        h = h or ""
        first[h] = min([x for x in (first.get(h), i) if x is not None], default=None)
    want = []
    for i, _, h in PAGES:
        b = (h or "").encode()
        revisit = first[h or ""] is not None and i != first[h or ""]
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response",
                     first[h or ""] if revisit else None))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    back = warc.read_archives(warc.write_archives(d, warc.scratch_path(spark, "w")), payloads=True).where("record_type = 'response'")
    assert Counter(bytes(r.payload).decode() for r in back.collect()) == Counter({"<p>one</p>": 2, "": 1, "<p>ñ</p>" * 5_000: 1, "only here": 1})
    assert warc.archive_pages(spark, d.where("page_id < 0")).count() == 0


def test_warc_reader_checks_framing_and_digests():
    good = [warc.record(i, "u", b"payload %d" % i, warc.sha1_base32(b"payload %d" % i), None) for i in range(3)]
    data = b"".join(map(warc.member, good))
    for size in (1, 7, 10 ** 6):
        pieces = iter([data[k:k + size] for k in range(0, len(data), size)])
        assert [warc.verified(*r)[1] for r in warc.read_records(pieces)] == [b"payload 0", b"payload 1", b"payload 2"]
    with pytest.raises(warc.FormatError):
        list(warc.read_records(iter([data[:-5]])))
    with pytest.raises(warc.FormatError):
        list(warc.read_records(iter([zlib.compress(b"no gzip")])))
    with pytest.raises(warc.FormatError):
        warc.split_record(good[0] + b"x")
    fields, block = warc.split_record(good[1])
    with pytest.raises(warc.FormatError):
        warc.verified(fields, block.replace(b"payload 1", b"payload 2"))


# ---------------------------------------------------------------- 10

def test_hypergeometric_draws_have_their_distribution():
    rng = np.random.default_rng(0)
    for good, bad, n in ((5, 7, 4), (300, 900, 200), (1, 1, 1), (0, 5, 3), (5, 0, 3), (10 ** 10, 7 * 10 ** 10, 10 ** 6)):
        x = np.array([sharding.draw_hypergeometric(rng, good, bad, n) for _ in range(2_000)])
        p, total = good / (good + bad), good + bad
        sd = (n * p * (1 - p) * (total - n) / max(1, total - 1)) ** 0.5
        assert abs(x.mean() - n * p) <= 5 * sd / 2_000 ** 0.5 + 1e-9 and abs(x.std() - sd) <= 0.1 * sd + 1e-9
        assert x.min() >= max(0, n - bad) and x.max() <= min(n, good)


def test_matrix_has_exact_sums():
    sizes = [0, 1, 17, 1_000, 3]
    m = sharding.communication_matrix(sizes, 8, 5)
    assert m.sum(axis=1).tolist() == sizes and m.min() >= 0
    assert m.sum(axis=0).max() - m.sum(axis=0).min() <= 1


def test_shards_are_exact_and_gapless(spark):
    rows = EDGES + [(100 + i, f"text {i}") for i in range(993)]
    d = sharding.with_digest(frame(spark, rows))
    out = sharding.digest(sharding.shard(d, ["doc_id", "text_crc32", "size"])).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = {k: sorted(r.slot for r in out if r["shard"] == k) for k in range(8)}
    assert all(s == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = sharding.shard(d.repartition(6), ["doc_id", "text_crc32", "size"])
    assert Counter(map(tuple, again.select("doc_id", "shard", "slot").collect())) == Counter((r.doc_id, r["shard"], r.slot) for r in out)
    assert sharding.shard(d.where("doc_id < 0"), ["doc_id"]).count() == 0
    full = sharding.shard(frame(spark), ["doc_id", "text"])
    assert full.columns == ["doc_id", "text", "kept", "shard", "slot"] and full.count() == len(EDGES)


@pytest.mark.parametrize("hot_rows", [10_000, 20])
def test_copies_of_a_row_spread_like_other_rows(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(sharding, "HOT_ROWS", hot_rows)
    rows = [(i, f"text {i}") for i in range(200) for _ in range(8)] + [(None, "no id")] * 800
    d = frame(spark, rows)
    out = sharding.shard(d, ["doc_id", "text"]).select("doc_id", "shard", "slot").collect()
    places = {}
    for r in out:
        places.setdefault(r.doc_id, []).append(r["shard"])
    same = [a == b for i, at in places.items() if i is not None for k, a in enumerate(at) for b in at[:k]]
    assert abs(np.mean(same) - 1 / 8) < 0.02                       # 5,600 pairs of copies
    hot = np.bincount(places[None], minlength=8)                   # hypergeometric: mean 100, deviation 7.6
    assert hot.sum() == 800 and abs(hot - 100).max() < 40
    order = [r.doc_id for r in sorted(out, key=lambda r: (r["shard"], r.slot)) if r.doc_id is not None]
    assert np.mean([a == b for a, b in zip(order, order[1:])]) < 0.03
    assert Counter(r["shard"] for r in out) == {k: 300 for k in range(8)}
    again = sharding.shard(d.repartition(6), ["doc_id", "text"]).select("doc_id", "shard", "slot").collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, out))
