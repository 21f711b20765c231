"""Operators 7 and 8, and the pipeline."""

import random

from conftest import SF0001
from pyspark.sql import functions as F

import corpus_pipeline
from glossa.llm import decontaminate, quality_bayes
from glossa.sources.tables import load


def words(rnd, n):
    return [rnd.choice("abcdefgh") + str(rnd.randrange(400)) for _ in range(n)]


# ---------------------------------------------------------------- 7

def test_classifier_on_held_out_documents(spark):
    docs = load(spark, "/root/testdata/sf0.01", "documents")
    labels = load(spark, "/root/testdata/sf0.01", "labels")
    seen = F.pmod(F.xxhash64("doc_id"), F.lit(3)) > 0
    got = quality_bayes.classify(docs, labels.where(seen)).join(labels.where(~seen), "doc_id")
    bad = (F.col("quality") == 0)
    rejected, all_bad, false, all_good = got.agg(
        F.sum((bad & ~F.col("kept")).cast("int")), F.sum(bad.cast("int")),
        F.sum((~bad & (F.col("toxic") == 0) & ~F.col("kept")).cast("int")), F.sum((~bad & (F.col("toxic") == 0)).cast("int"))).first()
    assert rejected >= 0.7 * all_bad and false <= 0.03 * all_good


def test_sparse_sites_shrink_toward_the_global_rate(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(400):                                   # one bad host, one host with a single document
        bad = i % 4 == 0
        text = " ".join(w + ("###" if bad else "") for w in words(rnd, 60))
        rows.append((i, text, "bad" if bad else "good", "p"))
    rows += [(900, " ".join(words(rnd, 60)), "lonely", None), (901, None, None, None), (902, "", "good", "p"), (0, rows[0][1], "bad", "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumn("kept", F.lit(1))
    labels = spark.createDataFrame([(i, 0 if i % 4 == 0 else 1, 0) for i in range(0, 400, 3)] + [(None, 1, None)], "doc_id long, quality int, toxic int")
    got = quality_bayes.classify(docs, labels).collect()
    assert len(got) == len(rows)
    rate = {r.doc_id: r.path_rate for r in got}
    assert rate[0] > rate[900] > rate[1]
    assert all(r.kept == (r.doc_id % 4 != 0) for r in got if r.doc_id < 400)
    assert quality_bayes.keep_good(docs, labels).columns == docs.columns
    assert quality_bayes.classify(docs.where("doc_id < 0"), labels).count() == 0
    assert quality_bayes.classify(docs, labels.where("doc_id < 0")).where("kept").count() == len(rows)


# ---------------------------------------------------------------- 8

def similarity(a, b, size):
    from collections import Counter
    x, y = (Counter(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) for w in (a, b))
    both = sum((x & y).values())
    return both / (sum(x.values()) + sum(y.values()) - both)


def test_decontamination_matches_brute_force(spark):
    rnd = random.Random(4)
    items = [words(rnd, rnd.choice([3, 5, 15, 40, 59])) for _ in range(30)]
    items[7] = items[6][:-1] + ["other"]
    items.append(["rep", "eat"] * 12)
    docs = []
    for i in range(120):
        w = words(rnd, rnd.choice([0, 4, 30, 300]))
        if i % 2:
            piece = list(items[rnd.randrange(len(items))])
            for _ in range(rnd.choice([0, 0, 1, 2, 6])):
                piece[rnd.randrange(len(piece))] = "edit"
            at = rnd.randint(0, len(w))
            w[at:at] = piece
        docs.append(w)
    want = {}
    for d, w in enumerate(docs):
        for k, item in enumerate(items):
            n, size = min(len(item), len(w)), min(5, len(item))
            best = max((similarity(w[s:s + n], item, size) for s in range(len(w) - n + 1)), default=0) if n >= size else 0
            if best >= 0.75:
                want[d, k] = best
    df = spark.createDataFrame([(i, " ".join(w).upper() if i % 5 == 0 else "\n".join(w), "x") for i, w in enumerate(docs)], "doc_id long, text string, start string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)] + [(99, None), (98, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(df.repartition(4), bench).collect()}
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-5 for k in want)
    plan = decontaminate.contaminated(df, bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_decontamination_finds_reordered_passages(spark):
    rnd = random.Random(9)
    items = [words(rnd, n) for n in (40, 60, 100, 58, 61, 90)] + [["rep", "eat"] * 20]
    docs = []
    for item in items:
        cut, third = len(item) // 2, len(item) // 3
        for parts in ([item[cut:], item[:cut]], [item[2 * third:], item[third:2 * third], item[:third]], [item[:third], ["x"], item[third:]]):
            for n in (0, 7, 300):
                docs.append(words(rnd, n) + sum(parts, []) + words(rnd, n))
    want = {}
    for d, w in enumerate(docs):
        for k, item in enumerate(items):
            n = min(len(item), len(w))
            best = max(similarity(w[s:s + n], item, 5) for s in range(len(w) - n + 1))
            if best >= 0.75:
                want[d, k] = best
    assert len({d for d, _ in want}) > 45                          # most of the 63 documents, swapped ones too
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(df.repartition(4), bench).collect()}
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-5 for k in want)


def test_decontamination_edges(spark):
    bench = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (None, "x a b c d e f g"), (3, None), (4, ""), (5, "clean " * 5_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in decontaminate.contaminated(docs, bench).collect()} == {1, None}
    assert sorted(r.doc_id for r in decontaminate.keep_clean(docs, bench).collect()) == [3, 4, 5]
    assert decontaminate.contaminated(docs, bench.where("item_id > 1")).count() == 0
    assert decontaminate.contaminated(docs.where("doc_id > 9"), bench).count() == 0


def test_items_without_id_are_found(spark):
    bench = spark.createDataFrame([(None, "a b c d e f g"), (None, "h i j k l m n")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x a b c d e f g"), (2, "clean text of some words")], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()] == [(1, None)]


# ---------------------------------------------------------------- pipeline

def test_pipeline_equals_its_stages(spark):
    docs = load(spark, SF0001, "documents")
    cols, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF0001)
        out = spark.createDataFrame(out.toPandas(), docs.schema)
        assert out.columns == cols
        if name != "mixing":
            assert 0.5 * n < out.count() <= n and out.select("doc_id").distinct().count() == out.count()
        else:                                              # only rows that came in, some of them repeated
            assert out.distinct().join(docs, "doc_id", "left_anti").isEmpty()
        docs, n = out, out.count()
    result = corpus_pipeline.run(spark, SF0001)
    assert result.columns == [*cols, "shard", "slot"]
    assert sorted(r.doc_id for r in result.collect()) == sorted(r.doc_id for r in docs.collect())
    sizes = [r["count"] for r in result.groupBy("shard").count().collect()]
    assert max(sizes) - min(sizes) <= 1
