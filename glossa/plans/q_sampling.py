"""Queries for shuffles, caps, balance, chunks and folds: L1-L3, W2, G1-G7, U2, U3."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossa.functions import text as T
from glossa.operators import labels as L
from glossa.operators import sampling as S
from glossa.plans import fixtures as X
from glossa.plans import sqlkit as Q
from glossa.plans.registry import query
from glossa.session import materialize

SEED = S.SEED
U = Q.u(SEED, "id")
CHUNK_SIZE = 100           # 100,000 in production; the tables here are far smaller


def labelled(spark, sf):
    return X.comments(spark, sf).where(F.col("toxic").isNotNull()).select("id", "lang", "toxic")


_LAB = "lab AS (SELECT id, lang, toxic FROM comments WHERE toxic IS NOT NULL)"


@query("l01_seeded_shuffle", X.with_fixtures(
    f"SELECT id, row_number() OVER (ORDER BY {U}, id) AS pos FROM comments", "comments"))
def l01_seeded_shuffle(spark, sf):
    return S.shuffle_positions(X.comments(spark, sf).select("id"), "id")


@query("l02_cap_after_shuffle", X.with_fixtures(
    f"SELECT id, lang FROM comments QUALIFY row_number() OVER (ORDER BY {U}, id) <= 250", "comments"))
def l02_cap_after_shuffle(spark, sf):
    return S.take_shuffled(X.comments(spark, sf).select("id", "lang"), 250, "id")


@query("l03_sample_n", X.with_fixtures(
    f"SELECT id, lang, toxic FROM lab QUALIFY row_number() OVER (ORDER BY {U}, id) <= 256", "comments", ctes=_LAB))
def l03_sample_n(spark, sf):
    return S.take_shuffled(labelled(spark, sf), 256, "id")


@query("w02_fold_row_number", X.with_fixtures(
    f"SELECT id, lang, CAST((row_number() OVER (PARTITION BY lang ORDER BY {U}, id) - 1) % 10 AS INT) AS fold "
    "FROM lab WHERE toxic = 0", "comments", ctes=_LAB))
def w02_fold_row_number(spark, sf):
    neg = labelled(spark, sf).where(F.col("toxic") == 0).select("id", "lang")
    d = S.shuffle_positions(neg, "id", part_cols=["lang"], out="rn")
    return d.select("id", "lang", F.pmod(F.col("rn") - 1, F.lit(10)).cast("int").alias("fold"))


def balance_input(spark, sf):
    """Two files: pool (subtitle) and labelled comments, thresholded and binarised."""
    p = L.band_filter(X.pool(spark, sf), "toxic", 0.2, 0.7).select(
        F.col("id").cast("string").alias("id"), "lang", L.binarise("toxic", 0.7).alias("toxic"),
        F.lit("subtitle").alias("file"))
    c = labelled(spark, sf).withColumn("file", F.lit("train"))
    return p.unionByName(c)


_BAL = ("bal AS (SELECT CAST(id AS VARCHAR) AS id, lang, CASE WHEN toxic >= 0.7 THEN 1 ELSE 0 END AS toxic, "
        "'subtitle' AS file FROM pool WHERE toxic < 0.2 OR toxic >= 0.7 "
        "UNION ALL SELECT id, lang, toxic, 'train' AS file FROM comments WHERE toxic IS NOT NULL)")


@query("g01_class_balance", X.with_fixtures(
    "SELECT id, lang, toxic, file FROM bal WHERE toxic = 1 UNION ALL "
    "SELECT b.id, b.lang, b.toxic, b.file FROM (SELECT *, row_number() OVER (PARTITION BY file ORDER BY "
    + U + ", id) AS rn FROM bal WHERE toxic = 0) b JOIN (SELECT file, least(sum(toxic) * 2, sum(1 - toxic)) AS cap "
    "FROM bal GROUP BY file) c ON b.file = c.file WHERE b.rn <= c.cap", "pool", "comments", ctes=_BAL))
def g01_class_balance(spark, sf):
    return S.class_balance(balance_input(spark, sf), "toxic", 2, "id", file_col="file")


def chunks(spark, sf):
    p = X.pool(spark, sf).withColumn("strata", T.composite_key("lang", "toxic"))
    return S.stratified_chunks(p, "strata", CHUNK_SIZE, "id")


def _chunk_ctes(name, source):
    """CTEs that put the rows of ``source`` (id, lang, toxic) into stratified chunks: the last one is ``name``."""
    t, o = f"{name}_t", f"{name}_o"
    k = f"(SELECT count(*) FROM {t}) // {CHUNK_SIZE}"
    return f"""{t} AS (SELECT *, lang || CAST(toxic AS VARCHAR) AS strata FROM {source}),
{o} AS (SELECT strata, coalesce(sum(n) OVER (ORDER BY strata ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
  FROM (SELECT strata, count(*) AS n FROM {t} GROUP BY strata)),
{name} AS (SELECT p.id, p.lang, p.toxic, p.strata, CAST(CASE WHEN {k} > 2
  THEN (so.off + row_number() OVER (PARTITION BY p.strata ORDER BY {Q.u(SEED, 'p.id')}, p.id) - 1) % ({k})
  ELSE 0 END AS INT) AS chunk FROM {t} p JOIN {o} so ON p.strata = so.strata)"""


_CHUNKS = _chunk_ctes("ch", "pool")


@query("g02_stratified_chunks", X.with_fixtures("SELECT id, strata, chunk FROM ch", "pool", ctes=_CHUNKS))
def g02_stratified_chunks(spark, sf):
    return chunks(spark, sf).select("id", "strata", "chunk")


@query("g03_chunk_cap", X.with_fixtures(
    "SELECT chunk, strata, CAST(count(*) AS BIGINT) AS n FROM ch WHERE chunk < 4 GROUP BY chunk, strata",
    "pool", ctes=_CHUNKS))
def g03_chunk_cap(spark, sf):
    c = S.chunk_cap(chunks(spark, sf), 4)
    return c.groupBy("chunk", "strata").agg(F.count(F.lit(1)).alias("n"))


@query("g04_fold_downsample", X.with_fixtures(
    "SELECT id, lang, toxic FROM lab WHERE toxic = 1 UNION ALL SELECT id, lang, toxic FROM "
    f"(SELECT *, row_number() OVER (PARTITION BY lang ORDER BY {U}, id) AS rn FROM lab WHERE toxic = 0) "
    "WHERE (rn - 1) % 10 = 3", "comments", ctes=_LAB))
def g04_fold_downsample(spark, sf):
    return S.fold_downsample(labelled(spark, sf), 3, "toxic", "id")


@query("g05_equal_class_downsample", X.with_fixtures(
    f"SELECT id, lang, toxic FROM (SELECT *, row_number() OVER (PARTITION BY toxic, lang ORDER BY {U}, id) AS rn "
    "FROM lab) WHERE rn <= (SELECT min(c) FROM (SELECT count(*) AS c FROM lab GROUP BY toxic, lang))",
    "comments", ctes=_LAB))
def g05_equal_class_downsample(spark, sf):
    return S.equal_class_downsample(labelled(spark, sf), ["toxic", "lang"], "id")


@query("g06_holdout_split", X.with_fixtures(
    f"SELECT id, CASE WHEN row_number() OVER (ORDER BY {U}, id) <= ceil((SELECT count(*) FROM lab) * CAST(0.1 AS DOUBLE)) "
    "THEN 'holdout' ELSE 'train' END AS split FROM lab", "comments", ctes=_LAB))
def g06_holdout_split(spark, sf):
    return S.holdout_split(labelled(spark, sf), "id").select("id", "split")


_ROUTED = ",\n".join([
    _CHUNKS, _LAB, _chunk_ctes("fo", "(SELECT * FROM lab WHERE lang <> 'en')"), _chunk_ctes("en", "(SELECT * FROM lab WHERE lang = 'en')"),
    "ro AS (SELECT 'subtitle' AS origin, CAST(id AS VARCHAR) AS id, chunk FROM ch UNION ALL SELECT 'foreign', id, chunk FROM fo "
    "UNION ALL SELECT 'english', id, chunk FROM en)"])


@query("g07_fold_routing", X.with_fixtures(
    "SELECT 'base' AS run, origin, id FROM ro WHERE (origin = 'foreign' AND chunk <= 5) OR (origin = 'english' AND chunk <= 1) "
    "UNION ALL SELECT 'fold' || CAST(chunk AS VARCHAR), origin, id FROM ro WHERE origin <> 'english' AND chunk <= 3 "
    "UNION ALL SELECT 'fold' || CAST(f AS VARCHAR), 'pseudo', c.id FROM comments c JOIN scores s ON c.id = s.id, "
    "(SELECT unnest(range(0, 4)) AS f) WHERE c.toxic IS NULL AND s.model = 'm0'",
    "pool", "comments", "scores", ctes=_ROUTED))
def g07_fold_routing(spark, sf):
    """The rows of the base model and of the four fold models: each file is chunked once."""
    c = materialize(X.comments(spark, sf).select("id", "lang", "toxic"))
    lab = c.where(F.col("toxic").isNotNull()).withColumn("strata", T.composite_key("lang", "toxic"))

    def file(df, origin):
        return df.select(F.lit(origin).alias("origin"), F.col("id").cast("string").alias("id"), "chunk")
    chunked = file(chunks(spark, sf), "subtitle")
    for origin, rows in (("foreign", lab.where(F.col("lang") != "en")), ("english", lab.where(F.col("lang") == "en"))):
        chunked = chunked.unionByName(file(S.stratified_chunks(rows, "strata", CHUNK_SIZE, "id"), origin))
    pseudo = L.pseudo_label(c.where(F.col("toxic").isNull()).select("id"), X.scores(spark, sf).where(F.col("model") == "m0"))
    return S.route_runs(chunked, pseudo)


_U2 = ("pc AS (SELECT id, " + Q.clean_text_mono("comment_text") + " AS comment_text, lang, toxic FROM pool "
       "WHERE comment_text IS NOT NULL)")


def pool_texts(spark, sf):
    p = X.pool(spark, sf).where(F.col("comment_text").isNotNull())
    p = p.select("id", T.clean_text_mono("comment_text").alias("comment_text"), "lang", "toxic")
    return S.dedupe_keep_first(p, ["lang", "comment_text"], "id")


@query("u02_dedupe_keep_first", X.with_fixtures(
    "SELECT comment_text, arg_min(id, id) AS id, lang, "
    "CAST(round_even(arg_min(toxic, id), 0) AS INT) AS toxic FROM pc GROUP BY lang, comment_text", "pool", ctes=_U2))
def u02_dedupe_keep_first(spark, sf):
    d = pool_texts(spark, sf)
    return d.select("comment_text", "id", "lang", L.round_label("toxic").alias("toxic"))


# The first two corpora are shuffled and capped, the subset is whole. The cap of the query is small
# enough to bite on every test table.
CORPUS_CAP = 300


@query("u03_mlm_corpus", X.with_fixtures(
    "SELECT corpus, origin, id, text FROM (SELECT *, row_number() OVER (PARTITION BY corpus ORDER BY "
    + Q.u(SEED, "corpus", "origin", "id") + ", origin, id) AS rn FROM ("
    "SELECT 'all' AS corpus, 'comments' AS origin, id, comment_text AS text FROM comments "
    "UNION ALL SELECT 'all', 'pool', CAST(id AS VARCHAR), comment_text FROM pool "
    "UNION ALL SELECT 'valid_test', 'comments', id, comment_text FROM comments WHERE toxic IS NULL "
    "UNION ALL SELECT 'subset', 'documents', CAST(doc_id AS VARCHAR), text FROM documents WHERE source = 'src0' "
    "UNION ALL SELECT 'subset', 'original', v.id, c.comment_text FROM views v JOIN comments c ON v.id = c.id WHERE v.original = 1)) "
    f"WHERE corpus = 'subset' OR rn <= {CORPUS_CAP}", "comments", "pool", "views"))
def u03_mlm_corpus(spark, sf):
    return mlm_corpora(spark, sf, CORPUS_CAP)


def mlm_corpora(spark, sf, cap):
    """Train + valid + test and valid + test, each at most ``cap`` rows of a seeded shuffle, and
    the uncapped subset (one source, and the original rows of the translated views)."""
    from glossa.sources.tables import load
    from glossa.operators.scale import row_number_by_uniform
    from glossa.functions import rand
    c = X.comments(spark, sf).select("id", F.col("comment_text").alias("text"), "toxic")

    def leg(df, corpus, origin):
        return df.select(F.lit(corpus).alias("corpus"), F.lit(origin).alias("origin"), F.col("id").cast("string").alias("id"), "text")
    capped = (leg(c, "all", "comments")
              .unionByName(leg(X.pool(spark, sf).withColumnRenamed("comment_text", "text"), "all", "pool"))
              .unionByName(leg(c.where(F.col("toxic").isNull()), "valid_test", "comments")))
    capped = capped.withColumn("_u", rand.uniform(SEED, F.col("corpus"), F.col("origin"), F.col("id")))
    capped = row_number_by_uniform(capped, "_u", ["origin", "id"], ["corpus"], out_col="_rn")
    original = X.views(spark, sf).where(F.col("original") == 1).select("id").join(c, "id")
    src0 = load(spark, sf, "documents").where(F.col("source") == "src0").withColumnRenamed("doc_id", "id")
    whole = leg(src0, "subset", "documents").unionByName(leg(original, "subset", "original"))
    return capped.where(F.col("_rn") <= cap).select("corpus", "origin", "id", "text").unionByName(whole)


CORPORA = ("all", "valid_test", "subset")


def corpus_texts(spark, sf):
    """``origin, id, text, bits``: every text once, with the corpora of ``mlm_corpora`` it is a candidate of."""
    from glossa.sources.tables import load
    original = X.views(spark, sf).where(F.col("original") == 1).select("id", F.lit(4).alias("_original")).dropDuplicates(["id"])
    c = X.comments(spark, sf).join(original, "id", "left")
    bits = F.lit(1) + F.when(F.col("toxic").isNull(), 2).otherwise(0) + F.coalesce("_original", F.lit(0))
    own = lambda df, origin, text, bits: df.select(
        F.lit(origin).alias("origin"), F.col("id").cast("string").alias("id"), F.col(text).alias("text"), bits.alias("bits"))
    src0 = load(spark, sf, "documents").where(F.col("source") == "src0").withColumnRenamed("doc_id", "id")
    return (own(c, "comments", "comment_text", bits).unionByName(own(X.pool(spark, sf), "pool", "comment_text", F.lit(1)))
            .unionByName(own(src0, "documents", "text", F.lit(4))))


def encoded_corpora(spark, sf, cap):
    """U3 encoded: ``corpus, origin, id`` with masked ids and targets. A text of several corpora is encoded and
    masked once."""
    from glossa.functions import tokens as K
    from glossa.operators import corpora as C
    from glossa.operators import vocab as V
    from glossa.plans import q_tokens as QT
    texts = C.cut_members(corpus_texts(spark, sf), CORPORA, {"all": cap, "valid_test": cap}, ["origin", "id"], SEED)
    e = V.encode_ids(texts, "id", K.word_tokens("text"), QT.vocabulary(spark, sf), carry=["origin", "bits"], vocab_size=QT.VOCAB_SIZE,
                     max_tokens=QT.MAX_LEN - 2)
    e = e.select("bits", "origin", "id", K.with_marks("raw_ids", QT.MAX_LEN, True).alias("ids"))
    inputs, labels = K.mlm_inputs_and_labels("ids", F.concat_ws("/", "origin", "id"), seed=QT.MLM_SEED, mask_id=QT.MASK_ID,
                                             random_ids=(K.UNK + 1, QT.MASK_ID))
    masked = e.select("bits", "origin", "id", QT.ids_str(inputs).alias("mlm_input_ids"), QT.ids_str(labels).alias("mlm_labels"))
    return C.by_corpus(masked, CORPORA)


def _u3_encoded_sql():
    from glossa.plans import q_tokens as QT
    ctes = f"""{QT._TOK},
{QT._VOCAB},
legs AS (SELECT 'all' AS corpus, 'comments' AS origin, id, comment_text AS text FROM comments
  UNION ALL SELECT 'all', 'pool', CAST(id AS VARCHAR), comment_text FROM pool
  UNION ALL SELECT 'valid_test', 'comments', id, comment_text FROM comments WHERE toxic IS NULL
  UNION ALL SELECT 'subset', 'documents', CAST(doc_id AS VARCHAR), text FROM documents WHERE source = 'src0'
  UNION ALL SELECT 'subset', 'comments', v.id, c.comment_text FROM views v JOIN comments c ON v.id = c.id WHERE v.original = 1),
chosen AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY corpus ORDER BY {Q.u(SEED, 'corpus', 'origin', 'id')}, origin, id) AS rn
  FROM legs) WHERE corpus = 'subset' OR rn <= {CORPUS_CAP}),
ctok AS (SELECT corpus, origin, id, list_filter(string_split({Q.clean_text('text')}, ' '), lambda t: t <> '') AS toks FROM chosen),
cex AS (SELECT corpus, origin, id, unnest(toks) AS token, unnest(range(len(toks))) AS pos FROM ctok),
cenc AS (SELECT corpus, origin, cex.id, list(coalesce(v.token_id, 3) ORDER BY pos) AS raw_ids FROM cex LEFT JOIN vocab v ON cex.token = v.token
  GROUP BY corpus, origin, cex.id),
cids AS (SELECT t.corpus, t.origin, t.id, t.origin || '/' || t.id AS rowkey,
  {QT.marks_sql('coalesce(e.raw_ids, CAST([] AS INT[]))', QT.MAX_LEN, True)} AS ids
  FROM ctok t LEFT JOIN cenc e ON t.corpus = e.corpus AND t.origin = e.origin AND t.id = e.id)"""
    return X.with_fixtures(f"SELECT corpus, origin, id, {QT.mlm_sql('rowkey')} FROM cids", "comments", "pool", "views", ctes=ctes)


@query("u03_mlm_encoded", _u3_encoded_sql())
def u03_mlm_encoded(spark, sf):
    return encoded_corpora(spark, sf, CORPUS_CAP)
