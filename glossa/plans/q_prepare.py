"""Queries for whole-file preparation (data prep: P1, P7, G2, G3, T8, K1, K3-K5 in one plan)."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossa.functions import tokens as K
from glossa.operators import prepare as P
from glossa.operators import vocab as V
from glossa.plans import fixtures as X
from glossa.plans import sqlkit as Q
from glossa.plans.q_sampling import CHUNK_SIZE, SEED
from glossa.plans.q_tokens import MAX_LEN, SPLIT_ENCODE_LEN, VOCAB_SIZE, WINDOW, ids_str, marks_sql
from glossa.plans.registry import query

MAX_CHUNK = 4


def train_file(spark, sf):
    """A training file: the conversation pool with its one-decimal label."""
    return X.pool(spark, sf).withColumnRenamed("toxic", "toxic_float")


def test_file(spark, sf):
    return X.comments(spark, sf)


def _prepared(df, file_type, action, should_chunk, max_chunk):
    # the vocabulary is counted over the file itself (the pretrained one is re-aimed)
    toks = P.select_file(df, file_type).select(K.word_tokens("comment_text").alias("toks"))
    vocab = V.build_vocab(toks, "toks", VOCAB_SIZE)
    out = P.prepare_file(df, file_type, vocab, long_comment_action=action, should_chunk=should_chunk,
                         max_chunk=max_chunk, chunk_size=CHUNK_SIZE, max_len=MAX_LEN, vocab_size=VOCAB_SIZE)
    return out.withColumn("input_ids", ids_str("input_ids"))


# ----------------------------------------------------------------------------- SQL twins

def _enc_sql(source_cte, cols, action, should_chunk, max_chunk):
    has_label = "toxic_float" in cols
    not_null = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    carry = ", ".join(c for c in cols if c not in ("id", "comment_text"))
    n = "(SELECT count(*) FROM tf)"
    if should_chunk and has_label:
        chunk = f"""pl AS (SELECT *, lang || CAST(toxic_float AS VARCHAR) AS strata FROM tf),
so AS (SELECT strata, coalesce(sum(n) OVER (ORDER BY strata ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
  FROM (SELECT strata, count(*) AS n FROM pl GROUP BY strata)),
ch0 AS (SELECT p.id, p.lang, p.comment_text, p.toxic_float, CAST(CASE WHEN {n} // {CHUNK_SIZE} > 2
  THEN (so.off + row_number() OVER (PARTITION BY p.strata ORDER BY {Q.u(SEED, 'p.id')}, p.id) - 1) % ({n} // {CHUNK_SIZE})
  ELSE 0 END AS INT) AS chunk FROM pl p JOIN so ON p.strata = so.strata),
ch AS (SELECT * FROM ch0 {'' if max_chunk is None else f'WHERE {n} // {CHUNK_SIZE} <= 2 OR chunk < {max_chunk}'})"""
    else:
        chunk = "ch AS (SELECT *, 0 AS chunk FROM tf)"
    words = f"list_filter(string_split({Q.clean_text('comment_text')}, ' '), lambda t: t <> '')"
    enc = f"""tf AS (SELECT {', '.join(cols)} FROM ({source_cte}) WHERE {not_null}),
{chunk},
cnt AS (SELECT t AS token, count(*) AS n FROM (SELECT unnest({words}) AS t FROM tf) GROUP BY t),
vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) + 3 AS INT) AS token_id FROM cnt
  QUALIFY row_number() OVER (ORDER BY n DESC, token) <= {VOCAB_SIZE}),
tok AS (SELECT id, {carry}, chunk, {words} AS toks FROM ch),
ex AS (SELECT id, unnest(toks) AS token, unnest(range(len(toks))) AS pos FROM tok),
enc0 AS (SELECT ex.id, list(coalesce(v.token_id, 3) ORDER BY ex.pos) AS raw_ids FROM ex LEFT JOIN vocab v ON ex.token = v.token GROUP BY ex.id),
enc AS (SELECT t.id, {', '.join('t.' + c for c in carry.split(', '))}, t.chunk, coalesce(e.raw_ids, CAST([] AS INT[])) AS raw_ids
  FROM tok t LEFT JOIN enc0 e ON t.id = e.id)"""
    return enc


def _rows_sql(carry, action):
    """CTEs ending in ``rows``: the prepared rows computed from ``enc``."""
    outcols = f"id, {', '.join(carry)}, chunk"
    if action == "split":
        ctes = f"""e1 AS (SELECT *, {marks_sql('raw_ids', SPLIT_ENCODE_LEN, False)} AS ids FROM enc),
e2 AS (SELECT *, list_transform(range(0, CAST(greatest(0, ceil((len(ids) - 2 - {MAX_LEN - 2}) / CAST({WINDOW} AS DOUBLE))) AS INT) + 1), lambda k: k * {WINDOW}) AS starts FROM e1),
e3 AS (SELECT *, unnest(starts) AS start FROM e2),
rows AS (SELECT {outcols}, array_to_string(list_resize(CASE WHEN len(ids) < {MAX_LEN} THEN ids
  ELSE list_concat(list_concat([0], list_slice(list_slice(ids, 2, len(ids) - 1), start + 1, start + {MAX_LEN - 2})), [2]) END,
  {MAX_LEN}, 1), ' ') AS input_ids FROM e3)"""
    else:
        where = f"WHERE len(raw_ids) + 2 < {MAX_LEN}" if action == "drop" else ""
        ctes = (f"rows AS (SELECT {outcols}, array_to_string({marks_sql('raw_ids', MAX_LEN, True)}, ' ') "
                f"AS input_ids FROM enc {where})")
    return ctes


def prepared_sql(fixture, source, cols, action, should_chunk, max_chunk, select="SELECT * FROM rows"):
    carry = [c for c in cols if c not in ("id", "comment_text")]
    ctes = _enc_sql(source, cols, action, should_chunk, max_chunk) + ",\n" + _rows_sql(carry, action)
    return X.with_fixtures(select, fixture, ctes=ctes)


_TRAIN_SRC = "SELECT id, lang, comment_text, toxic AS toxic_float FROM pool"
_TEST_SRC = "SELECT id, lang, comment_text FROM comments"
_TRAIN_COLS = P.FILE_COLUMNS["train"]
_TEST_COLS = P.FILE_COLUMNS["test"]


# ----------------------------------------------------------------------------- registered queries

@query("d01_prepare_train_split", prepared_sql("pool", _TRAIN_SRC, _TRAIN_COLS, "split", True, MAX_CHUNK))
def d01_prepare_train_split(spark, sf):
    return _prepared(train_file(spark, sf), "train", "split", True, MAX_CHUNK)


@query("d02_prepare_test_drop", prepared_sql("comments", _TEST_SRC, _TEST_COLS, "drop", False, None))
def d02_prepare_test_drop(spark, sf):
    return _prepared(test_file(spark, sf), "test", "drop", False, None)


@query("d03_prepare_train_ignore", prepared_sql("pool", _TRAIN_SRC, _TRAIN_COLS, "ignore", False, None))
def d03_prepare_train_ignore(spark, sf):
    return _prepared(train_file(spark, sf), "train", "ignore", False, None)


@query("d04_prepare_chunk_sizes", prepared_sql(
    "pool", _TRAIN_SRC, _TRAIN_COLS, "split", True, MAX_CHUNK,
    select="SELECT chunk, CAST(count(*) AS BIGINT) AS n FROM rows GROUP BY chunk"))
def d04_prepare_chunk_sizes(spark, sf):
    out = _prepared(train_file(spark, sf), "train", "split", True, MAX_CHUNK)
    return out.groupBy("chunk").agg(F.count(F.lit(1)).alias("n"))
