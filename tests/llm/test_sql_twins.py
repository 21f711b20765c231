"""The SQL of operators 1, 4, 6 and 9 on small tables with awkward texts."""

import random

import duckdb
import pyarrow as pa
import pytest

from glossa.llm import near_dedup, substring_dedup, suffix_dedup, warc


def texts():
    rng = random.Random(7)
    words = ["ä", "B", "b", "côté", "x y", "日本", "w1", "w2", "Straße", "ÄÖ"]
    long = " ".join(rng.choice(words) + str(rng.randrange(30)) for _ in range(120))
    rows = [None, "", "  \n\t", "one", "One  two", "one two", long, long.upper(), long + " end of it", "pre " + long, long[:300] + long[150:],
            long.replace(" ", "\x0b", 9), "a" * 350, "é" * 260, "a b " * 60]
    rows += [" ".join(rng.choice(words) for _ in range(rng.randrange(60))) for _ in range(12)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i * 3 + 1, t) for i, t in enumerate(texts())], "doc_id long, text string").repartition(3)


def _agree(spark, got, sql, **tables):
    con = duckdb.connect()
    for name, rows in tables.items():
        con.register(name, pa.Table.from_pylist([r.asDict() for r in rows]))
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(got.columns)
    want = sorted(cur.fetchall(), key=str)
    assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=str) == want
    return want


def test_substring_dedup(spark, docs):
    got = substring_dedup.digest(substring_dedup.dedup_substrings(docs))
    assert sum(r[2] for r in _agree(spark, got, substring_dedup.ORACLE_SQL, documents=docs.collect())) > 100


def test_suffix_dedup(spark, docs):
    got = suffix_dedup.digest(suffix_dedup.dedup_suffixes(docs))
    assert sum(r[2] for r in _agree(spark, got, suffix_dedup.ORACLE_SQL, documents=docs.collect())) > 1_000


def test_near_dedup(spark, docs):
    got = near_dedup.digest(near_dedup.near_duplicates(docs))
    want = _agree(spark, got, near_dedup.ORACLE_SQL, documents=docs.collect())
    assert sum(not r[3] for r in want) >= 3


def test_warc(spark):
    html = ["<p>ä</p>", None, "", "<p>ä</p>", "x" * 5_000, "", "tail", "x" * 5_000]
    pages = spark.createDataFrame([(i, f"http://h/{i}", h) for i, h in enumerate(html)], "page_id long, url string, html string").repartition(2)
    got = warc.digest(warc.archive_pages(spark, pages))
    want = _agree(spark, got, warc.ORACLE_SQL, pages=pages.collect())
    assert sum(r[3] == "revisit" for r in want) == 4
