"""The running AUC against the AUC of each prefix, pair by pair."""

import random

import pytest

from glossa.operators import metrics as M


def brute(rows, prior):
    seen = [(-1, y, p) for y, p in M.PRIOR_ROWS] if prior else []
    rows = [r for r in rows if None not in r]
    out = {}
    for b in sorted({r[0] for r in rows}):
        part = seen + [r for r in rows if r[0] <= b]
        pos, neg = [p for _, y, p in part if y == 1], [p for _, y, p in part if y == 0]
        won = sum((x > n) + 0.5 * (x == n) for x in pos for n in neg)
        out[b] = (sum(1 for r in rows if r[0] <= b), won / (len(pos) * len(neg)) if pos and neg else None)
    return out


@pytest.mark.parametrize("prior", [True, False])
def test_each_update_equals_the_auc_of_its_prefix(spark, prior):
    rnd = random.Random(7)
    data = []
    for model, batches, levels in (("a", list(range(13)), 5), ("b", [0, 1, 1000, 4097], 50), ("c", [3], 1), ("d", [7] * 9 + [8], 2)):
        for _ in range(160):
            b = rnd.choice(batches)
            data.append((model, b, rnd.randint(0, 1), 0.25 if rnd.random() < 0.3 else rnd.randint(0, levels) / levels))
    data += [("e", 0, 1, 0.9), ("e", 1, 1, 0.1), ("e", 5, 0, 0.1), ("a", 3, None, 0.1), ("a", 3, 1, None), ("a", None, 1, 0.5)]
    df = spark.createDataFrame(data, "model string, batch long, y int, p double")
    got = {(r.model, r.batch): (r.n_rows, r.auc) for r in M.running_auc(df, "y", "p", "batch", ["model"], prior=prior).collect()}
    want = {(m, b): v for m in "abcde" for b, v in brute([r[1:] for r in data if r[0] == m], prior).items()}
    assert got.keys() == want.keys()
    for k, (n, auc) in want.items():
        assert got[k][0] == n
        assert (got[k][1] is None) == (auc is None) and (auc is None or abs(got[k][1] - auc) < 1e-12), k


def test_without_groups_and_empty(spark):
    df = spark.createDataFrame([(0, 1, 0.2), (2, 0, 0.4), (2, 1, 0.4)], "batch long, y int, p double")
    got = {r.batch: (r.n_rows, r.auc) for r in M.running_auc(df, "y", "p", "batch").collect()}
    assert got == {b: (n, pytest.approx(a)) for b, (n, a) in brute([(0, 1, 0.2), (2, 0, 0.4), (2, 1, 0.4)], True).items()}
    assert M.running_auc(df.where("batch > 9"), "y", "p", "batch").count() == 0


@pytest.mark.parametrize("node_rows", [0, 20, 10 ** 6])
def test_large_and_small_nodes_give_the_same(spark, node_rows):
    rnd = random.Random(3)
    data = [(rnd.choice([None, "a"]), rnd.randint(0, 30), rnd.randint(0, 1), rnd.randint(0, 9) / 9) for _ in range(300)]
    df = spark.createDataFrame(data, "model string, batch long, y int, p double")
    got = {(r.model, r.batch): (r.n_rows, pytest.approx(r.auc)) for r in M.running_auc(df, "y", "p", "batch", ["model"], node_rows=node_rows).collect()}
    want = {(m, b): v for m in (None, "a") for b, v in brute([r[1:] for r in data if r[0] == m], True).items()}
    assert got == want


def test_a_long_table_is_joined_by_sorting(spark):
    from glossa.operators import scale as S
    ids = spark.range(S.BROADCAST_ROWS + 1)
    plan = lambda n: S.join_table(ids, ids.limit(n).withColumn("x", ids.id), ["id"])._jdf.queryExecution().executedPlan().toString()      # noqa: E731
    assert "BroadcastHashJoin" not in plan(S.BROADCAST_ROWS + 1) and "SortMergeJoin" in plan(S.BROADCAST_ROWS + 1)
    assert "BroadcastHashJoin" in plan(5)
