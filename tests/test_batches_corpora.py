"""User functions on batches of like length (M2, F1) and corpora as bitmasks."""

import random

import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from glossa.functions import rand
from glossa.operators import batches as B
from glossa.operators import corpora as C


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=60), st.integers(1, 100), st.integers(1, 9))
def test_cuts_cover_all_rows_within_their_bounds(lengths, cells, rows):
    lengths = sorted(lengths)
    got = B.cuts(lengths, cells, rows)
    assert [i for a, b in got for i in range(a, b)] == list(range(len(lengths)))
    assert all(b - a <= rows and (b - a == 1 or max(lengths[a:b]) * (b - a) <= cells) for a, b in got)


def _skewed(n=2_000):
    rng = random.Random(5)
    return [(i, rng.choice([3, 4, 5, 200]) if i % 50 else None) for i in range(n)]


def test_batches_waste_little_padding_and_models_are_loaded_once_a_process(spark):
    df = spark.createDataFrame(_skewed(), "id long, n int").repartition(2)

    def load():
        import os
        import uuid
        mark = f"{os.getpid()}/{uuid.uuid4()}"
        return lambda pdf: pd.Series([f"{mark}/{len(pdf)}/{pdf['n'].fillna(0).max():.0f}"] * len(pdf))
    got = B.apply_in_batches(df, f"probe-{random.random()}", load, "seen", "string", "n", cells=2_000).collect()
    assert sorted((r.id, r.n) for r in got) == sorted(_skewed())
    by_process, padded = {}, 0.0
    for r in got:
        pid, mark, rows, longest = r.seen.split("/")
        by_process.setdefault(pid, set()).add(mark)
        padded += int(longest)
        assert int(rows) * int(longest) <= 2_000
    assert all(len(marks) == 1 for marks in by_process.values())
    assert padded < 1.1 * sum(n or 0 for _, n in _skewed())          # rows in table order would be padded to 200 nearly always


def test_batches_replace_a_column_keep_the_others_and_take_an_empty_table(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, None, 6)], "id long, t string, out int")
    d = B.apply_in_batches(df, "upper", lambda: lambda pdf: pdf["t"].str.upper(), "out", "string", F.length("t"))
    assert d.columns == ["id", "t", "out"] and sorted(map(tuple, d.collect())) == [(1, "a", "A"), (2, None, None)]

    def broken():
        raise RuntimeError("loaded for nothing")
    assert B.apply_in_batches(df.where("id > 5"), "broken", broken, "x", "double", "id").count() == 0


def test_wrong_number_of_values_is_an_error(spark):
    df = spark.range(4)
    with pytest.raises(Exception, match="returned 1 values"):
        B.apply_in_batches(df.coalesce(1), "short", lambda: lambda pdf: pd.Series([1.0]), "x", "double", F.lit(1)).collect()


def test_rows_are_ordered_without_a_shuffle(spark):
    plan = B.apply_in_batches(spark.range(9), "none", lambda: lambda p: p["id"], "x", "long", "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" in plan


CORPORA = ("all", "new", "whole")


def _texts(n):
    return [(f"o{i % 3}", f"{i}", (1 if i % 5 else 0) + (2 if i % 4 == 0 else 0) + (4 if i % 7 == 0 else 0)) for i in range(n)]


@pytest.mark.parametrize("n, caps", [(200, {"all": 30, "new": 7}), (60, {"all": 500, "new": 5}), (40, {"all": 1, "new": 400}), (0, {"all": 3, "new": 2})])
def test_members_of_capped_corpora(spark, n, caps):
    df = spark.createDataFrame(_texts(n), "origin string, id string, bits int")
    got = C.by_corpus(C.cut_members(df, CORPORA, caps, ["origin", "id"], 11), CORPORA).collect()
    want = set()
    for i, c in enumerate(CORPORA):
        rows = [(o, d) for o, d, bits in _texts(n) if bits & (1 << i)]
        if c in caps:
            keyed = df.where(F.col("bits").bitwiseAND(1 << i) != 0).withColumn("u", rand.uniform(11, F.lit(c), F.col("origin"), F.col("id")))
            u = {(r.origin, r.id): r.u for r in keyed.collect()}
            rows = sorted(rows, key=lambda r: (u[r], r))[:caps[c]]
        want |= {(c, *r) for r in rows}
    assert {(r.corpus, r.origin, r.id) for r in got} == want and len(got) == len(want)


def test_texts_are_not_shuffled_for_their_corpora(spark, tmp_path):
    spark.createDataFrame(_texts(50), "origin string, id string, bits int").withColumn("text", F.lit("t")).write.parquet(str(tmp_path / "t"))
    d = C.by_corpus(C.cut_members(spark.read.parquet(str(tmp_path / "t")), CORPORA, {"all": 9, "new": 4}, ["origin", "id"], 3), CORPORA)
    plan = d._jdf.queryExecution().optimizedPlan().toString().split("scalar-subquery")[0]
    assert "Join" not in plan and "Aggregate" not in plan
    physical = d._jdf.queryExecution().sparkPlan()           # the outer plan; the keys are ranked in the subquery
    assert "Generate" in physical.toString().split("Subquery")[0]
    d.collect()
