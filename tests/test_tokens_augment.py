"""Token windows, masks, MLM targets and the augmentation router."""

import pytest
from pyspark.sql import functions as F

from glossa.functions import tokens as K
from glossa.operators import augment as AU
from glossa.operators import vocab as V


@pytest.mark.parametrize("n,starts", [(5, [0]), (191, [0]), (192, [0]), (193, [0, 100]), (292, [0, 100]), (293, [0, 100, 200]),
                                      (1000, [0, 100, 200, 300, 400, 500, 600, 700, 800, 900])])
def test_split_windows(spark, n, starts):
    content = list(range(10, 10 + n - 2))
    df = spark.createDataFrame([([0] + content + [2],)], "ids array<int>")
    got = df.select(F.posexplode(K.window_starts("ids", 192, 100)).alias("w", "s"), "ids") \
        .select("w", K.window_ids("ids", "s", 192).alias("x")).orderBy("w").collect()
    assert [r.x[1] for r in got] == [content[s] for s in starts]         # where each window begins
    for r, s in zip(got, starts):
        marks = [0] + content[s:s + 190] + [2]
        assert r.x == marks + [1] * (192 - len(marks))
    assert {t for r in got for t in r.x if t >= 10} == set(content)      # nothing is lost


def test_marks_truncate_and_pad(spark):
    df = spark.createDataFrame([([5, 6, 7],), (list(range(4, 20)),)], "r array<int>")
    got = [r[0] for r in df.select(K.with_marks("r", 6, True)).collect()]
    assert got == [[0, 5, 6, 7, 2, 1], [0, 4, 5, 6, 7, 2]]


def test_mask_and_length(spark):
    df = spark.createDataFrame([([0, 5, 2, 1, 1],)], "ids array<int>")
    r = df.select(K.attention_mask("ids").alias("m"), K.token_length("ids").alias("n")).collect()[0]
    assert r.m == [1, 1, 1, 0, 0] and r.n == 3


def test_mlm_never_touches_special_ids(spark):
    ids = [0] + [1000 + i for i in range(300)] + [2] + [1] * 20
    df = spark.createDataFrame([(str(k), ids) for k in range(20)], "id string, ids array<int>")
    inp, lab = K.mlm_inputs_and_labels("ids", F.col("id"), seed=1)
    rows = df.select("ids", inp.alias("x"), lab.alias("y")).collect()
    sel = masked = 0
    for r in rows:
        for a, x, y in zip(r.ids, r.x, r.y):
            if a <= 2:
                assert x == a and y == -1
            elif y != -1:
                sel += 1
                assert y == a
                masked += x != a
            else:
                assert x == a
    n = 20 * 300
    assert 0.12 < sel / n < 0.18 and 0.85 < masked / sel < 0.95


def test_vocab_and_encode(spark):
    df = spark.createDataFrame([("a", "x y x z"), ("b", "y x"), ("c", "")], "id string, t string")
    toks = df.select("id", K.word_tokens("t").alias("toks"))
    vocab = V.build_vocab(toks, "toks", 2)
    assert sorted((r.token, r.token_id) for r in vocab.collect()) == [("x", 4), ("y", 5)]
    enc = {r.id: r.raw_ids for r in V.encode_ids(df, "id", K.word_tokens("t"), vocab, vocab_size=2).collect()}
    assert enc == {"a": [4, 5, 4, 3], "b": [5, 4], "c": []}


@pytest.mark.parametrize("words,route", [(57, "mix"), (58, "keep"), (177, "keep"), (178, "shuffle")])
def test_length_router_edges(spark, words, route):
    # token length = words + 2 marks: 59 -> mix, 60 -> keep, 179 -> keep, 180 -> shuffle
    import itertools
    # distinct digit-free words in one sentence: the cleaning chain keeps them all
    text = " ".join("".join(p) for p in itertools.islice(itertools.product("abcdefghij", repeat=3), words))
    df = spark.createDataFrame([("r1", "en", 0, text)], "id string, lang string, toxic int, comment_text string")
    pool = spark.createDataFrame([(1, "en", "p one", 0), (2, "en", "p two", 1)],
                                 "id long, lang string, comment_text string, toxic int")
    got = AU.length_router(df, pool).collect()
    assert len(got) == 1 and got[0].route == route


def test_vocab_ranks_ties_by_token(spark):
    from collections import Counter
    # counts with heavy ties (many tokens seen once, shared prefixes) and a multi-byte token
    words = [f"w{i % 37}" for i in range(400)] + [f"rare{i}" for i in range(300)] + ["é", "é", "ab", "abc"]
    df = spark.createDataFrame([(words[i:i + 7],) for i in range(0, len(words), 7)], "toks array<string>")
    order = sorted(Counter(words).items(), key=lambda t: (-t[1], t[0].encode()))
    for size in (5, 40, 1000):
        got = sorted((r.token_id, r.token) for r in V.build_vocab(df, "toks", size).collect())
        assert got == [(i + 4, t) for i, (t, _) in enumerate(order[:size])]


def test_encode_cuts_before_the_explode(spark):
    vocab = spark.createDataFrame([("x", 4), ("y", 5)], "token string, token_id int")
    df = spark.createDataFrame([("a", ["x", "y", "z"]), ("b", ["y"]), ("c", None)], "id string, t array<string>")
    cut = {r.id: (r.n_tokens, r.raw_ids) for r in V.encode_ids(df, "id", "t", vocab, max_tokens=2).collect()}
    assert cut == {"a": (3, [4, 5]), "b": (1, [5]), "c": (0, [])}
    short = V.encode_ids(df, "id", "t", vocab, below=3)
    assert {r.id: r.raw_ids for r in short.collect()} == {"b": [5], "c": []}
    plan = short._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("< 3")          # the length filter stands below the explode


def test_encode_tells_views_of_one_id_apart(spark):
    vocab = spark.createDataFrame([("x", 4)], "token string, token_id int")
    df = spark.createDataFrame([("a", "en", ["x"]), ("a", "fr", ["q", "x"])], "id string, view string, t array<string>")
    got = {r.view: r.raw_ids for r in V.encode_ids(df, "id", "t", vocab, carry=["view"]).collect()}
    assert got == {"en": [4], "fr": [3, 4]}


def test_repeated_document_ids_raise(spark):
    vocab = spark.createDataFrame([("x", 4), ("y", 5)], "token string, token_id int")
    df = spark.createDataFrame([("a", ["x", "y"]), ("a", ["y"])], "id string, t array<string>")
    with pytest.raises(Exception, match="not unique"):
        V.encode_ids(df, "id", "t", vocab).collect()


def test_mlm_draws_one_hash_for_a_position_that_is_not_selected(spark):
    from glossa.functions import rand
    d = spark.range(400).select(F.col("id").cast("string").alias("k"))
    for p in (0.0, 0.15, 1 / 9, 0.9, 0.5, 1.0):
        r = d.select(rand.uniform_below(p, 7, F.col("k")).alias("a"), (rand.uniform(7, F.col("k")) < F.lit(p)).alias("b")).collect()
        assert all(x.a == x.b for x in r)
    d = d.select("k", F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: i.cast("int")).alias("ids")).withColumn("draws", K.mlm_draws("ids", F.col("k"), seed=5))
    x, y = K.mlm_inputs_and_labels("ids", F.col("k"), seed=5, draws="draws")
    x2, y2 = K.mlm_inputs_and_labels("ids", F.col("k"), seed=5)
    out = d.select(x.alias("x"), y.alias("y"), x2.alias("x2"), y2.alias("y2"))
    assert all(r.x == r.x2 and r.y == r.y2 for r in out.collect())
    plan = d.select(x, y)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("|sel") <= 1 and plan.count("md5(") <= 4


def test_both_views_read_one_cleaned_text(spark):
    from glossa.plans.q_model import view_scores
    plan = view_scores(spark, "/root/testdata/sf0.001", ["lin_a"])._jdf.queryExecution().optimizedPlan().toString()
    # once for both views, and once more for the view that is cleaned again
    assert plan.count("regexp_replace(") and plan.count(', https?') == 2
