"""Queries for vocabulary, encoding, windows, masks and MLM targets."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossa.functions import tokens as K
from glossa.operators import vocab as V
from glossa.plans import fixtures as X
from glossa.plans import sqlkit as Q
from glossa.plans.registry import query

# --- fixed values ------------------------------------------------------------
VOCAB_SIZE = 2000
MAX_LEN = 192          # model input length
SPLIT_ENCODE_LEN = 1000
WINDOW = 100
MLM_SEED = 42
MASK_ID = K.UNK + 1 + VOCAB_SIZE       # the id after the vocabulary's last
# -----------------------------------------------------------------------------


def ids_str(c):
    c = F.col(c) if isinstance(c, str) else c
    return F.array_join(c.cast("array<string>"), " ")


def tokenised(spark, sf):
    return X.comments(spark, sf).select("id", "lang", "toxic", K.word_tokens("comment_text").alias("toks"))


def vocabulary(spark, sf):
    return V.build_vocab(tokenised(spark, sf), "toks", VOCAB_SIZE)


def encoded(spark, sf, max_tokens=None, below=None):
    """``id, lang, toxic, n_tokens, raw_ids``. The vocabulary counts every token; the encoding
    reads the scan again and keeps ``max_tokens`` tokens of the documents ``below`` a length."""
    c = X.comments(spark, sf)
    return V.encode_ids(c, "id", K.word_tokens("comment_text"), vocabulary(spark, sf), carry=["lang", "toxic"],
                        vocab_size=VOCAB_SIZE, max_tokens=max_tokens, below=below)


def split_windows(spark, sf):
    e = encoded(spark, sf, SPLIT_ENCODE_LEN - 2).withColumn("ids", K.with_marks("raw_ids", SPLIT_ENCODE_LEN, pad=False))
    w = e.select("id", "lang", "toxic", "ids",
                 F.posexplode_outer(K.window_starts("ids", MAX_LEN, WINDOW)).alias("win", "start"))
    return w.select("id", "lang", "toxic", "win", "start", K.window_ids("ids", "start", MAX_LEN).alias("input_ids"),
                    F.size("ids").alias("n_encoded"))


# ----------------------------------------------------------------------------- SQL twins

_TOK = (f"tok AS (SELECT id, lang, toxic, list_filter(string_split({Q.clean_text('comment_text')}, ' '), "
        f"lambda t: t <> '') AS toks FROM comments)")
_VOCAB = f"""cnt AS (SELECT t AS token, count(*) AS n FROM (SELECT unnest(toks) AS t FROM tok) GROUP BY t),
vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) + 3 AS INT) AS token_id FROM cnt
  QUALIFY row_number() OVER (ORDER BY n DESC, token) <= {VOCAB_SIZE})"""
_ENC = """ex AS (SELECT id, unnest(toks) AS token, unnest(range(len(toks))) AS pos FROM tok),
enc0 AS (SELECT ex.id, list(coalesce(v.token_id, 3) ORDER BY ex.pos) AS raw_ids FROM ex LEFT JOIN vocab v ON ex.token = v.token GROUP BY ex.id),
enc AS (SELECT t.id, t.lang, t.toxic, coalesce(e.raw_ids, CAST([] AS INT[])) AS raw_ids FROM tok t LEFT JOIN enc0 e ON t.id = e.id)"""
_BASE = ",\n".join([_TOK, _VOCAB, _ENC])


def marks_sql(raw, max_len, pad):
    ids = f"list_concat(list_concat([0], list_slice({raw}, 1, {max_len - 2})), [2])"
    return f"list_resize({ids}, {max_len}, 1)" if pad else ids


def _sql(select, extra=""):
    return X.with_fixtures(select, "comments", ctes=_BASE + ("," + extra if extra else ""))


_SPLIT = f"""e1 AS (SELECT id, lang, toxic, {marks_sql('raw_ids', SPLIT_ENCODE_LEN, False)} AS ids FROM enc),
e2 AS (SELECT *, list_transform(range(0, CAST(greatest(0, ceil((len(ids) - 2 - {MAX_LEN - 2}) / CAST({WINDOW} AS DOUBLE))) AS INT) + 1), lambda k: k * {WINDOW}) AS starts FROM e1),
e3 AS (SELECT id, lang, toxic, ids, unnest(starts) AS start FROM e2),
wins AS (SELECT id, lang, toxic, CAST(start / {WINDOW} AS INT) AS win, start, len(ids) AS n_encoded,
  list_resize(CASE WHEN len(ids) < {MAX_LEN} THEN ids
       ELSE list_concat(list_concat([0], list_slice(list_slice(ids, 2, len(ids) - 1), start + 1, start + {MAX_LEN - 2})), [2]) END,
     {MAX_LEN}, 1) AS input_ids FROM e3)"""


# ----------------------------------------------------------------------------- registered queries

@query("k02_vocab_build", _sql("SELECT token, token_id FROM vocab"))
def k02_vocab_build(spark, sf):
    return V.build_vocab(tokenised(spark, sf), "toks", VOCAB_SIZE)


@query("k01_encode", _sql(
    f"SELECT id, len(raw_ids) AS n_tokens, array_to_string({marks_sql('raw_ids', SPLIT_ENCODE_LEN, False)}, ' ') AS input_ids FROM enc"))
def k01_encode(spark, sf):
    e = encoded(spark, sf, SPLIT_ENCODE_LEN - 2)
    return e.select("id", "n_tokens",
                    F.array_join(K.with_marks("raw_ids", SPLIT_ENCODE_LEN, False).cast("array<string>"), " ")
                    .alias("input_ids"))


@query("k03_split_windows", _sql(
    "SELECT id, lang, win, start, n_encoded, array_to_string(input_ids, ' ') AS input_ids FROM wins", _SPLIT))
def k03_split_windows(spark, sf):
    w = split_windows(spark, sf)
    return w.select("id", "lang", "win", "start", "n_encoded", ids_str("input_ids").alias("input_ids"))


@query("a15_split_summary", _sql(
    "SELECT CAST(count(DISTINCT CASE WHEN n_encoded < 192 THEN id END) AS BIGINT) AS unchanged_docs, "
    "CAST(count(DISTINCT CASE WHEN n_encoded >= 192 THEN id END) AS BIGINT) AS split_docs, "
    "CAST(sum(CASE WHEN n_encoded >= 192 THEN 1 ELSE 0 END) AS BIGINT) AS split_rows, CAST(count(*) AS BIGINT) AS out_rows FROM wins",
    _SPLIT))
def a15_split_summary(spark, sf):
    w = split_windows(spark, sf)
    long_ = F.col("n_encoded") >= MAX_LEN
    per_doc = w.groupBy("id").agg(F.first("n_encoded").alias("n_encoded"), F.count(F.lit(1)).alias("rows"))
    return per_doc.agg(
        F.sum(F.when(~long_, 1).otherwise(0)).cast("bigint").alias("unchanged_docs"),
        F.sum(F.when(long_, 1).otherwise(0)).cast("bigint").alias("split_docs"),
        F.sum(F.when(long_, F.col("rows")).otherwise(0)).cast("bigint").alias("split_rows"),
        F.sum("rows").cast("bigint").alias("out_rows"))


@query("k04_drop_long", _sql(
    f"SELECT id, array_to_string({marks_sql('raw_ids', MAX_LEN, True)}, ' ') AS input_ids FROM enc WHERE len(raw_ids) + 2 < {MAX_LEN}"))
def k04_drop_long(spark, sf):
    e = encoded(spark, sf, below=MAX_LEN - 2)
    return e.select("id", ids_str(K.with_marks("raw_ids", MAX_LEN, True)).alias("input_ids"))


@query("k05_truncate", _sql(
    f"SELECT id, lang, array_to_string({marks_sql('raw_ids', MAX_LEN, True)}, ' ') AS input_ids FROM enc"))
def k05_truncate(spark, sf):
    e = encoded(spark, sf, MAX_LEN - 2)
    return e.select("id", "lang", ids_str(K.with_marks("raw_ids", MAX_LEN, True)).alias("input_ids"))


@query("k06_attention_mask", _sql(
    f"SELECT id, array_to_string(list_transform(ids, lambda x: CASE WHEN x <> 1 THEN 1 ELSE 0 END), ' ') AS attention_mask, "
    f"CAST(list_sum(list_transform(ids, lambda x: CASE WHEN x <> 1 THEN 1 ELSE 0 END)) AS INT) AS token_length "
    f"FROM (SELECT id, {marks_sql('raw_ids', MAX_LEN, True)} AS ids FROM enc)"))
def k06_attention_mask(spark, sf):
    e = encoded(spark, sf, MAX_LEN - 2).select("id", K.with_marks("raw_ids", MAX_LEN, True).alias("ids"))
    return e.select("id", ids_str(K.attention_mask("ids")).alias("attention_mask"),
                    K.token_length("ids").alias("token_length"))


def mlm_sql(key):
    """SQL of the inputs and labels of ``ids``; draws are keyed by ``key``."""
    def uu(tag):
        return Q.u(MLM_SEED, key, "(i - 1)", f"'{tag}'")
    sel = f"(x > 2 AND {uu('sel')} < 0.15)"
    msk = f"({sel} AND {uu('mask')} < 0.9)"
    rnd = f"({msk} AND {uu('rnd')} < CAST(1 AS DOUBLE) / CAST(9 AS DOUBLE))"
    rid = f"CAST(floor({uu('rid')} * {VOCAB_SIZE}) + {K.UNK + 1} AS INT)"
    inputs = f"list_transform(ids, lambda x, i: CASE WHEN {rnd} THEN {rid} WHEN {msk} THEN {MASK_ID} ELSE x END)"
    labels = f"list_transform(ids, lambda x, i: CASE WHEN {sel} THEN x ELSE -1 END)"
    return f"array_to_string({inputs}, ' ') AS mlm_input_ids, array_to_string({labels}, ' ') AS mlm_labels"


@query("k07_mlm_mask", _sql(f"SELECT id, {mlm_sql('id')} FROM (SELECT id, {marks_sql('raw_ids', MAX_LEN, True)} AS ids FROM enc)"))
def k07_mlm_mask(spark, sf):
    e = encoded(spark, sf, MAX_LEN - 2).select("id", K.with_marks("raw_ids", MAX_LEN, True).alias("ids"))
    made = {"seed": MLM_SEED, "mask_id": MASK_ID, "random_ids": (K.UNK + 1, MASK_ID)}
    e = e.withColumn("draws", K.mlm_draws("ids", F.col("id"), **made))
    inputs, labels = K.mlm_inputs_and_labels("ids", F.col("id"), **made, draws="draws")
    return e.select("id", ids_str(inputs).alias("mlm_input_ids"), ids_str(labels).alias("mlm_labels"))


@query("k08_one_hot", X.with_fixtures(
    "SELECT id, array_to_string([1.0 - CAST(toxic AS DOUBLE), CAST(toxic AS DOUBLE)], ' ') AS target "
    "FROM comments WHERE toxic IS NOT NULL", "comments"))
def k08_one_hot(spark, sf):
    c = X.comments(spark, sf).where(F.col("toxic").isNotNull())
    return c.select("id", F.array_join(K.one_hot("toxic").cast("array<string>"), " ").alias("target"))
