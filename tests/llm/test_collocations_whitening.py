"""Operators 11 and 13 against brute force, and their edge cases."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from glossa.llm import collocations as C
from glossa.llm import feast, whitening as W


# --- operator 11 -------------------------------------------------------------------

def brute(docs, support, top):
    n, f = Counter(), Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    cand = {p: a for p, a in f.items() if a >= support and len(p[1]) >= 2}
    inside = {(lang, g[i:j], a) for (lang, g), a in cand.items() for i in range(len(g)) for j in range(i + 2, len(g) + 1) if j - i < len(g)}
    out = {}
    for (lang, g), a in cand.items():
        if (lang, g, a) not in inside:
            s, k = min((1000 * a * n[lang] // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g)))
            out.setdefault(lang, []).append((-s, -a, " ".join(g).encode(), f[lang, g[:k]], f[lang, g[k:]]))
    rows = []
    for lang, found in out.items():
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            rows.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(rows)


def corpus(seed, size):
    rng = random.Random(seed)
    vocab = ["the", "of", "New", "york", "a", "é", "ßx", "#", "x y", "is"]
    docs = []
    for i in range(size):
        words = [rng.choice(vocab) for _ in range(rng.choice([0, 1, 3, 60, 200]))]
        if rng.random() < 0.5:
            words[5:5] = "on the other Hand side".split()
        docs.append((i, "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", ":"]) for w in words), rng.choice(["en", "de", None])))
    docs += [(900, "wide " * 3000, "fr"), (901, None, "en"), (902, "", None), (903, " .,;\n", "de")]
    docs += [(904, "copy of one long text that returns " * 8, "en")] * 30
    return docs


def mine(spark, docs, support, top):
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    got = C.digest(C.collocations(df.withColumn("phrase", F.lit(1)).withColumn("f", F.lit("x")).repartition(3), support=support, top=top))
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("support,top", [(20, 2000), (100, 7)])
def test_collocations_equal_brute_force(spark, support, top):
    docs = corpus(support, 120)
    assert mine(spark, docs, support, top) == brute(docs, support, top)


def test_collocation_sql_twin_agrees_with_brute_force():
    docs = corpus(5, 150)
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, lang varchar)")
    con.executemany("insert into documents values (?, ?, ?)", docs)
    got = con.execute(f"select lang, rank, phrase, a, l, r, n, score from ({C.ORACLE_SQL})").fetchall()
    assert sorted(got) == brute(docs, 100, 2000)


def test_chunks_cover_every_phrase_once():
    rng = random.Random(1)
    for size in (0, 1, 4, 5, 30, 3000):
        words = [f"w{rng.randrange(40)}" for _ in range(size)]
        got = Counter()
        parts = C.chunks(" ".join(words).encode())
        if parts:
            where = C.Positions([c for c, _ in parts], np.array([m for _, m in parts]), np.ones(len(parts), np.int64))
            for i in np.flatnonzero(where.start):
                for k in range(1, 6):
                    if where.next[i:i + k - 1].all() and i + k <= len(where.key):
                        got[where.text[where.first[i]:where.last[i + k - 1]]] += 1
        want = Counter(" ".join(words[i:i + k]).encode() for i in range(size) for k in range(1, 6) if i + k <= size)
        assert got == want


def test_equal_passages_share_chunks(spark):
    """The dictionary of many copies is no larger than that of one text."""
    text = " ".join(f"w{i * 7919 % 997}" for i in range(2000))
    one = C.dictionary(spark.createDataFrame([(text, "en")], "text string, lang string"))
    many = C.dictionary(spark.createDataFrame([(text, "en")] * 400, "text string, lang string").repartition(4))
    assert one.count() == many.count() and many.agg(F.min("freq")).first()[0] == 400


def test_collocation_score_passes_64_bits(spark):
    """Products are exact beyond 64 bits."""
    row = spark.sql("select cast(1e13 as decimal(19,0)) * cast(9e15 as decimal(19,0)) * cast(1000 as decimal(4,0)) "
                    "div (cast(3e14 as decimal(19,0)) * cast(1e13 as decimal(19,0))) as s").first()
    assert row["s"] == 1000 * 10**13 * 9 * 10**15 // (3 * 10**14 * 10**13)


def test_collocations_of_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert C.collocations(empty).count() == 0
    assert C.collocations(spark.createDataFrame([(1, None, None), (1, "", "en")], "doc_id long, text string, lang string")).count() == 0


def test_very_long_text(spark):
    docs = [(1, "spam eggs and more spam " * 60_000, None)]
    got = mine(spark, docs, 100, 5)
    assert got == brute(docs, 100, 5)


# --- operator 13 -------------------------------------------------------------------

def vectors(seed, n, d, copies=0):
    rng = np.random.default_rng(seed)
    x = (rng.standard_normal((n, d)) * np.linspace(2, 0.2, d)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    return rows + [(1000 + i, rows[0][1]) for i in range(copies)]


BAD = [(2001, None), (2002, [math.nan] + [0.0] * 7), (2003, [math.inf] + [0.0] * 7), (2004, [None] + [0.0] * 7), (2005, [3e38] + [0.0] * 7),
       (2006, [1.0]), (2007, [])]


def test_whitening_equals_dense_solution(spark):
    rows = vectors(3, 300, 8, copies=40)
    df = spark.createDataFrame(rows + BAD, "vec_id long, embedding array<float>").withColumn("x", F.lit("s")).withColumn("n", F.lit(1)).repartition(3)
    got = W.digest(W.whiten(df)).collect()
    x = np.floor(256 * np.array([v for _, v in rows], np.float32).astype(float)).astype(int)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    v = (fit - s / n).T @ (fit - s / n) / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:4], u[:, ::-1][:, :4]
    by = {(r["vec_id"], r["component"]): r for r in got}
    assert len(got) == len(by) == 4 * len(rows)
    flip = np.sign([[by[rows[0][0], c + 1]["whitened"] * ((x[0] - s / n) @ u[:, c]) for c in range(4)]])[0]
    for (vec_id, _), xi in zip(rows, x):
        for c in range(4):
            r = by[vec_id, c + 1]
            assert r["n"] == n and r["deviation"] == int(((n * xi - s) ** 2).sum())
            assert r["whitened"] == pytest.approx(flip[c] * ((xi - s / n) @ u[:, c]) / math.sqrt(e[c]), abs=1e-9)
            assert r["explained"] == pytest.approx(e[c] / np.trace(v), rel=1e-9) and r["identity_error"] < 1e-9


def test_whitening_edge_cases(spark):
    schema = "vec_id long, embedding array<float>"
    assert W.whiten(spark.createDataFrame([], schema)).count() == 0
    assert W.whiten(spark.createDataFrame(BAD[:5], schema)).count() == 0
    assert W.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 5, schema)).count() == 0            # no variance
    one = W.digest(W.whiten(spark.createDataFrame([(None, [1.0, 5.0]), (None, [2.0, 5.0]), (7, [2.0, 5.0])], schema))).collect()
    assert sorted(r["component"] for r in one) == [1, 1, 1] and {r["n"] for r in one} == {2}
    assert all(abs(abs(r["whitened"]) - 1) < 1e-12 and r["explained"] == 1.0 for r in one)
    named = W.whiten(spark.createDataFrame([("a", [0.5, 1.0]), ("b", [1.5, 1.0])], "key string, v array<double>"), "key", "v")
    assert {r["key"] for r in named.collect()} == {"a", "b"}


def test_deviation_beyond_64_bits(spark):
    big = [(1, [3e15, 0.0]), (2, [-3e15, 1.0]), (3, [0.0, 0.0])]
    df = spark.createDataFrame(big, "vec_id long, embedding array<double>")
    wide = {r["vec_id"]: int(r["deviation"]) for r in W.whiten(df).where("component = 1").collect()}
    assert wide[1] == (3 * 256 * 3 * 10**15) ** 2 + 256 ** 2
    assert {r["deviation"] for r in W.digest(W.whiten(df)).collect()} == {None, 256 ** 2}


@pytest.mark.parametrize("spectrum", ["even", "tied", "rank2", "equal", "decay"])
def test_feast_finds_the_largest_eigenpairs(spectrum):
    rng = np.random.default_rng(11)
    d = 40
    e = {"even": 100 + rng.random(d), "tied": np.r_[[9.0, 5, 5, 5, 5, 5], rng.random(d - 6)], "rank2": np.r_[[5.0, 3], np.zeros(d - 2)],
         "equal": np.full(d, 3.0), "decay": 2.0 ** -np.arange(d)}[spectrum]
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    a = (q * e) @ q.T
    values, axes = feast.top_components(a, 4)
    want = np.sort(e)[::-1][:4]
    want = want[want > 1e-9]
    assert values == pytest.approx(want, rel=1e-12)
    assert np.abs(axes @ a - values[:, None] * axes).max() < 1e-12 * e.max()
    assert np.abs(axes @ axes.T - np.eye(len(values))).max() < 1e-12
    for shift in (0.3, 4.0, 100.5):
        assert feast.inertia_above(a, shift) == (e > shift).sum()
