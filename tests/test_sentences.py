"""Sentence borders with learned abbreviations, against hand cases and a plain recount."""

import math
import time
from itertools import permutations

from glossa.functions import text as T
from glossa.operators import augment as AU
from glossa.operators import sentences as SN
from pyspark.sql import functions as F

EN = ["Dr. Smith met Dr. Brown in town. They talked to Dr. White about it.",
      "We saw the town. It was cold. The doctor was in town with friends. Nobody else came along.",
      "A long walk followed (as Dr. Gray said). Then all went home. Rain fell on the town."]
DE = ["Es gibt viele Tiere, z.B. Hunde und Katzen. Das ist z.B. Anna bekannt.",
      "Wir gehen heute los. Morgen kommt Regen. Danach ist alles gut."]


def frame(spark):
    rows = [(str(i), "en", t) for i, t in enumerate(EN)] + [(str(10 + i), "de", t) for i, t in enumerate(DE)]
    rows += [("20", None, "Dr. Who came. Bye."), ("21", "en", None), ("22", "en", "")]
    return spark.createDataFrame(rows, "id string, lang string, t string")


def test_learned_types_and_scores_match_a_recount(spark):
    got = {(r.lang, r.token): r for r in SN.learn_abbreviations(frame(spark), "t", "lang").collect()}
    assert ("en", "dr") in got and ("de", "z.b") in got and ("en", "town") not in got
    assert ("de", "dr") not in got
    toks = [w for t in EN for w in t.split()]
    share = sum(w.endswith(".") for w in toks) / len(toks)
    ratio = 2 * (4 * math.log(0.99) - 4 * math.log(share))
    r = got["en", "dr"]
    assert (r.n_period, r.n_plain) == (4, 0)
    assert abs(r.score - ratio * math.exp(-2)) < 1e-9


def expect():
    return {"0": [EN[0].split(" They")[0], "They" + EN[0].split(" They")[1]],
            "2": ["A long walk followed (as Dr. Gray said).", "Then all went home.", "Rain fell on the town."],
            "10": [DE[0].split(" Das")[0], "Das ist z.B. Anna bekannt."],
            "21": None, "22": [""]}


def test_no_border_after_an_abbreviation_by_lookup_and_by_join(spark):
    d = frame(spark)
    abbr = SN.learn_abbreviations(d, "t", "lang").where("token IN ('dr', 'z.b')")
    for most in (SN.LOOKUP_MAX, 0):
        got = {r.id: r.sentences for r in SN.split_sentences(d, "t", "lang", abbr, "id", lookup_max=most).collect()}
        assert {k: got[k] for k in expect()} == expect()
        assert len(got) == 8


def test_without_abbreviations_it_is_the_plain_split(spark):
    d = spark.createDataFrame([("1", "x", " Lead. Two  blanks.\n\nEnd! No.border? "), ("2", None, "...")], "id string, lang string, t string")
    none = SN.learn_abbreviations(d, "t", "lang", threshold=1e9)
    for most in (10, -1):
        rows = SN.split_sentences(d, "t", "lang", none, "id", lookup_max=most).withColumn("plain", T.sentences("t")).collect()
        assert all(r.sentences == r.plain for r in rows) and len(rows) == 2


def test_split_is_a_projection(spark):
    d = frame(spark)
    plan = SN.split_sentences(d, "t", "lang", SN.learn_abbreviations(d, "t", "lang"), "id")._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subquery")[0]
    assert "Generate" not in main and "Join" not in main


def test_options_take_learned_sentences(spark):
    d = spark.createDataFrame([("1", "en", "Dr. A came. Dr. A came. Dr. B left.")], "id string, lang string, t string")
    abbr = spark.createDataFrame([("en", "dr")], "lang string, token string")
    s = SN.split_sentences(d, "t", "lang", abbr, "id")
    r = s.select(T.dedupe_sentences("t", F.col("sentences")).alias("a"), T.clean_text_mono("t", F.col("sentences")).alias("b"),
                 AU.shuffle_sentences("t", F.col("id"), pieces=F.col("sentences")).alias("c")).first()
    assert r.a == r.b == "Dr. A came. Dr. B left."
    orders = {" ".join(x) for x in permutations(["Dr. A came.", "Dr. A came.", "Dr. B left."])}
    assert r.c in orders


def test_empty_table(spark):
    d = frame(spark).where("id = 'none'")
    abbr = SN.learn_abbreviations(d, "t", "lang")
    assert abbr.count() == 0 and SN.split_sentences(d, "t", "lang", abbr, "id").count() == 0


def test_time_grows_with_the_sentences_of_a_text(spark):
    n = 6000
    text = " ".join(["Dr. A came to the town.", "Rain fell."] * (n // 2))
    d = spark.createDataFrame([("1", "en", text)], "id string, lang string, t string")
    abbr = spark.createDataFrame([("en", "dr")], "lang string, token string")
    began = time.time()
    r = SN.split_sentences(d, "t", "lang", abbr, "id").first().sentences
    assert time.time() - began < 15
    assert r == ["Dr. A came to the town.", "Rain fell."] * (n // 2)
