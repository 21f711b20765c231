"""Operator 4 against brute force."""

import random
import re

import numpy as np
import pytest

from glossa.llm import near_dedup as N


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    comp = {i: i for i in sets}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                comp[y] = x
    return sorted((i, len(sets[i]), root(i), root(i) == i) for i in sets)


def corpus():
    rnd = random.Random(11)
    vocab = ["w%d" % i for i in range(400)]
    rows = []
    for base in range(6):
        words = [rnd.choice(vocab) for _ in range(120)]
        for copy in range(25):
            w = list(words)
            for _ in range(rnd.choice([0, 1, 2, 3, 5])):       # around the threshold
                w[rnd.randrange(len(w))] = "edit%d" % rnd.randrange(10 ** 6)
            rows.append((len(rows), " ".join(w).upper() if copy % 7 == 3 else "\n".join(w)))
    rows += [(900, None), (901, ""), (902, "one two"), (903, "One  two"), (904, "one two three"), (905, "z " * 3000)]
    return rows


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 4)
    df = spark.createDataFrame([(i, t, "x") for i, t in corpus()], "doc_id long, text string, key string").repartition(4)
    assert sorted(map(tuple, N.digest(N.near_duplicates(df)).collect())) == brute(corpus())


def test_repeated_rows_null_ids_and_empty(spark):
    text = " ".join("w%d" % i for i in range(30))
    df = spark.createDataFrame([(4, text), (4, text), (None, text), (None, None), (7, "other words")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in N.near_duplicates(df).collect())
    assert got == [(-1, -1, True), (-1, 4, False), (4, 4, True), (4, 4, True), (7, 7, True)]
    assert N.keep_one(df).count() == 4
    assert N.near_duplicates(df.where("doc_id = 99")).count() == 0


def test_stage_leaves_one_row_of_each_group(spark):
    import corpus_pipeline
    text, other = (" ".join(f"{x}{i}" for i in range(60)) for x in "wv")
    near, last = text + " end", other + " end"
    rows = [(4, text), (4, text), (4, near), (None, text), (8, near)] + [(None, other)] * 20 + [(None, last)] * 20
    rows += [(7, "other words"), (9, None), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_dups(spark, df, "").collect()]
    assert sum(t in (text, near) and i == 4 for i, t in got) == 1
    assert sum(t in (other, last) and i is None for i, t in got) == 1
    assert sorted(i for i, t in got if t in ("other words", None)) == [7, 9, 9] and len(got) == 5


def test_signature_estimates_similarity():
    h = N.CirculantMinHash()
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2 ** 63, 1400, dtype=np.uint64)
    a, b = pool[:1000], pool[400:]
    assert abs((h.signature(a) == h.signature(b)).mean() - 600 / 1400) < 0.1


@pytest.mark.parametrize("n", [1, 3, 40])
def test_block_comparison_finds_all_pairs(n):
    rng = np.random.default_rng(n)
    sets = [np.unique(rng.integers(0, 60, 50).astype(np.uint32)) for _ in range(n)]
    got = N._similar_pairs([(0, i, i, x) for i, x in enumerate(sets)], (0, 0, 0))
    want = {(i, j) for i in range(n) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))}
    assert {(max(p), min(p)) for p in zip(got["a"].to_pylist(), got["b"].to_pylist())} == want
