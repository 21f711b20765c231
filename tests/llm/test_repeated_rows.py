"""Rows that repeat a thousand times, parallel reading of archives, and the formulas of the site posteriors."""

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from glossa.llm import near_dedup, quality_bayes, repeats, substring_dedup, suffix_dedup, warc
from glossa.llm.storage import scratch_path

SCHEMA = "doc_id long, text string"


def prose(seed, n=80):
    rng = random.Random(seed)
    return [f"w{rng.randrange(500)}" for _ in range(n)]


@pytest.mark.parametrize("dedup", [substring_dedup.dedup_substrings, suffix_dedup.dedup_suffixes])
@pytest.mark.parametrize("hot", [25, 2])
def test_a_thousand_equal_rows_without_id(spark, monkeypatch, dedup, hot):
    """The packed rows do not grow with the number of equal rows, whether their minimisers are salted or not."""
    monkeypatch.setattr(repeats, "SAMPLE_HOT", hot)
    packed = []
    real = repeats.stored

    def spy(df, name):
        out = real(df, name)
        if name == "packed":
            packed.append(out.count())
        return out
    monkeypatch.setattr(repeats, "stored", spy)
    shared = prose(1)
    other, copy = " ".join(prose(2) + shared[:50] + prose(3)), " ".join(shared)
    counts = []
    for m in (100, 1000):                                   # so many that the sample calls their minimisers frequent
        rows = [(5, other)] + [(None, copy)] * m
        got = dedup(spark.createDataFrame(rows, SCHEMA).repartition(6)).groupBy("doc_id", "n_removed").count().collect()
        counts.append({(r["doc_id"], r["n_removed"]): r["count"] for r in got})
    assert packed[0] == packed[1]
    assert set(counts[0]) == set(counts[1]) and counts[1] == {k: 1 if k[0] == 5 else 1000 for k in counts[0]}
    assert all(n > 0 for i, n in counts[0] if i is None)


def test_two_near_copies_repeated_a_thousand_times(spark, monkeypatch):
    """A node has one text however many rows share it."""
    sizes = {}
    real = near_dedup.stored

    def spy(df, name):
        out = real(df, name)
        if name == "texts":
            sizes["texts"] = out.count()
        return out
    monkeypatch.setattr(near_dedup, "stored", spy)
    a = prose(4, 60)
    b = a[:-1] + ["edited"]
    rows = [(1, " ".join(a))] * 1000 + [(None, " ".join(b))] * 1000 + [(9, " ".join(prose(5)))]
    got = near_dedup.digest(near_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(6)))
    counts = {(r["doc_id"], r["component_id"]): r["count"] for r in got.groupBy("doc_id", "component_id").count().collect()}
    assert counts == {(1, 1): 1000, (None, 1): 1000, (9, 9): 1} and sizes["texts"] == 2


def test_archives_are_read_in_parallel(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2_000)
    pages = spark.createDataFrame([(i, None, f"<p>{i}</p>" * 50) for i in range(60)], "page_id long, url string, html string").repartition(12)
    manifest = warc.write_archives(pages, scratch_path(spark, "w"))
    n = manifest.count()
    tasks = warc.read_archives(manifest).withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert n > 3 and len(tasks) == n


def test_site_posteriors_match_the_formula(spark):
    """Host and path rates and the posterior of each document, recomputed from the evidence."""
    rng = random.Random(6)
    rows = []
    for i in range(300):
        bad = rng.random() < 0.3
        words = prose(i, 40)
        rows.append((i, " ".join(w + "###" if bad else w for w in words), rng.choice(["h1", "h2", None]), rng.choice(["p", "q", None])))
    rows += [(400, None, "h1", "p"), (None, "", "lonely", None), (0, rows[0][1], "h2", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, 0 if "###" in (t or "") else 1, 0) for i, t, _, _ in rows[::2] if i is not None],
                                   "doc_id long, quality int, toxic int")
    model = quality_bayes.train(docs, labels)
    got = quality_bayes.quality_scores(docs.withColumn("evidence", F.lit("x")), model).collect()
    assert len(got) == len(rows)
    p_of = {t: 1 / (1 + math.exp(-model.log_odds((t or "").encode()))) for _, t, _, _ in rows}
    n, b = defaultdict(float), defaultdict(float)
    for _, t, host, path in rows:
        for key in ((), (host,), (host, path)):
            n[key] += 1
            b[key] += p_of[t]
    rate = min(0.99, max(0.001, b[()] / n[()]))
    want = defaultdict(list)
    for i, t, host, path in rows:
        hr = (b[host,] + quality_bayes.HOST_PRIOR * rate) / (n[host,] + quality_bayes.HOST_PRIOR)
        pr = (b[host, path] + quality_bayes.PATH_PRIOR * hr) / (n[host, path] + quality_bayes.PATH_PRIOR)
        p = min(0.99, max(0.001, pr))
        odds = model.log_odds((t or "").encode()) - math.log(rate / (1 - rate)) + math.log(p / (1 - p))
        want[i].append((hr, pr, 1 / (1 + math.exp(-odds))))
    for r in got:
        found = (r["host_rate"], r["path_rate"], r["bad_probability"])
        assert any(found == pytest.approx(w, abs=1e-9) for w in want[r["doc_id"]])
        assert r["kept"] == (r["bad_probability"] <= quality_bayes.REJECT)


def test_classifier_of_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_bayes.classify(docs, labels).count() == 0
    one = spark.createDataFrame([(1, "a b", None, None)], docs.schema)
    assert [(r["kept"], r["doc_id"]) for r in quality_bayes.classify(one, labels).collect()] == [(True, 1)]
    assert quality_bayes.keep_good(one, labels).count() == 1


def test_word_list_counts_copies_once(spark):
    """A word of one toxic text repeated often is not listed; words of many toxic texts are, whatever their number."""
    rng = random.Random(7)
    insults = [f"insult{k}" for k in range(40)]
    rows = []
    for i in range(900):
        toxic = i % 4 == 0
        words = prose(i, 30) + (rng.sample(insults, 12) if toxic else [])
        rows.append((" ".join(words), int(toxic)))
    rows += [("quixotic " + " ".join(prose(0, 30)), 1)] * 300 + [("null label", None)]
    listed = quality_bayes.learn_words(quality_bayes.clusters(spark.createDataFrame(rows, "text string, toxic int")))
    assert {w.decode() for w in listed} == set(insults)
