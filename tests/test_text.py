"""T1-T14 on hand-made rows, against Python ``re`` semantics."""

import re

import pytest
from pyspark.sql import functions as F

from glossa.functions import text as T

# fixed values: the patterns of the specification, in Python regex terms
PY = {
    "t1": lambda s: re.sub(r'[0-9"]', "", s),
    "t2": lambda s: re.sub(r"#[\S]+\b", "", s),
    "t3": lambda s: re.sub(r"@[\S]+\b", "", s),
    "t4": lambda s: re.sub(r"https?\S+", "", s),
    "t5": lambda s: re.sub(r"\s+", " ", s),
    "t7": lambda s: s.strip(),
}


def py_clean(s):
    for k in ("t1", "t2", "t3", "t4", "t5"):
        s = PY[k](s)
    return s




ROWS = ["#", "##", "#é", "#tag!", "#a_b-", "@usér.", "mail @bob, #x1 end", "  a b \x1c",
        "\ttabbed\t", "see https://x.y/z?q=1 now", 'quote "it" 42 times', "x y　z",
        "plain text", ""]


def _apply(spark, fn, rows=ROWS):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, s string")
    return [r[1] for r in sorted(df.select("i", fn("s").alias("o")).collect())]


@pytest.mark.parametrize("key,fn", [("t1", T.strip_digits_quotes), ("t2", T.strip_hashtags),
                                    ("t3", T.strip_mentions), ("t4", T.strip_urls),
                                    ("t5", T.collapse_ws), ("t7", T.py_strip)])
def test_single_steps_match_python(spark, key, fn):
    assert _apply(spark, fn) == [PY[key](r) for r in ROWS]


def test_clean_text_matches_python(spark):
    assert _apply(spark, T.clean_text) == [py_clean(r) for r in ROWS]


def test_dedupe_sentences(spark):
    rows = ["Hi there.  Hi there. Bye!", "Hi there.\tHi   there. ok", "no stop mark at all", "",
            "A? A? B. A?"]
    assert _apply(spark, T.dedupe_sentences, rows) == [
        "Hi there. Bye!", "Hi there. Hi   there. ok", "no stop mark at all", "", "A? B."]


def test_clean_text_mono(spark):
    rows = ["  #tag Hi 12.  Hi 34.  ", "x"]
    assert _apply(spark, T.clean_text_mono, rows) == ["Hi .", "x"]


def test_template_flag(spark):
    rows = ["Bonjour, x (bot de maintenance)  ", " Bonjour, y Salebot (d)", "Bonjour, z", "hello (bot de maintenance)",
            None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, s string")
    got = [r[1] for r in sorted(df.select("i", T.is_template_message("s")).collect())]
    assert got == [True, True, False, False, False]


def test_ipv4_flag(spark):
    rows = ["from 10.0.0.1 today", "1.2.3", "v1.22.333.4444", None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, s string")
    got = [r[1] for r in sorted(df.select("i", T.has_ipv4("s")).collect())]
    assert got == [1, 0, 1, 0]


def test_text_functions_stay_in_the_jvm(spark):
    df = spark.createDataFrame([(1, "a b")], "i int, s string").select(T.clean_text_mono("s"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_blanks_collapse_and_strip_as_in_python(spark):
    import random
    import re
    rnd = random.Random(11)
    marks = [" ", " ", "\n", "\t", "\u00a0", "\u2003", "\x0b", "\x1d", "\x85", "\u3000", "\u2028", "a", "é", "!", "日", "~", "😀", "\x7f"]
    texts = ["", " ", "\n", "a\n", "a \n", "\r\na", None] + ["".join(rnd.choices(marks, k=rnd.randint(0, 12))) for _ in range(600)]
    d = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.collapse_ws("t").alias("c"), T.py_strip("t").alias("s"))
    for r in d.collect():
        assert r.c == (None if r.t is None else re.sub(r"\s+", " ", r.t)) and r.s == (None if r.t is None else r.t.strip())
