"""Queries for the model operators: M1-M3."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossa.functions import tokens as K
from glossa.functions import text as T
from glossa.operators import batches as BT
from glossa.operators import ensemble as E
from glossa.operators import labels as L
from glossa.operators import model as MD
from glossa.operators import sampling as S
from glossa.operators import variants as VR
from glossa.operators import vocab as V
from glossa.plans import fixtures as X
from glossa.plans.registry import query, r6
from glossa.session import materialize, scratch_path


def _lin_sql(ids, name):
    a, b = MD.LINEAR_SCORERS[name]
    s = (f"list_reduce(list_transform({ids}, lambda x: CAST((x * {a} + {b}) % 101 - 50 AS DOUBLE) / CAST(1000 AS DOUBLE)), "
         f"lambda p, q: p + q)")
    return f"(1.0 / (1.0 + exp(-{s})))"


def _m2_sql():
    from glossa.plans.q_tokens import MAX_LEN, _sql, marks_sql
    return _sql(f"SELECT id, round({_lin_sql(marks_sql('raw_ids', MAX_LEN, True), 'lin_a')}, 6) AS toxic FROM enc")


@query("m02_batch_score", _m2_sql())
def m02_batch_score(spark, sf):
    from glossa.plans.q_tokens import MAX_LEN, encoded
    e = encoded(spark, sf, MAX_LEN - 2).select("id", K.with_marks("raw_ids", MAX_LEN, True).alias("ids"))
    return e.select("id", r6(MD.linear_score("ids", "lin_a")).alias("toxic"))


def _m3_sql(digits=", 6"):
    from glossa.plans import sqlkit as Q
    from glossa.plans.q_tokens import MAX_LEN, _BASE, marks_sql
    clean = (f"tok2 AS (SELECT id, list_filter(string_split({Q.clean_text(Q.clean_text_mono('comment_text'))}, ' '), "
             f"lambda t: t <> '') AS toks FROM comments),\n"
             "ex2 AS (SELECT id, unnest(toks) AS token, unnest(range(len(toks))) AS pos FROM tok2),\n"
             "enc2a AS (SELECT ex2.id, list(coalesce(v.token_id, 3) ORDER BY ex2.pos) AS raw_ids FROM ex2 "
             "LEFT JOIN vocab v ON ex2.token = v.token GROUP BY ex2.id),\n"
             "enc2 AS (SELECT t.id, coalesce(e.raw_ids, CAST([] AS INT[])) AS raw_ids FROM tok2 t LEFT JOIN enc2a e ON t.id = e.id),\n"
             f"views AS (SELECT id, 'orig' AS view, {marks_sql('raw_ids', MAX_LEN, True)} AS ids FROM enc "
             f"UNION ALL SELECT id, 'clean' AS view, {marks_sql('raw_ids', MAX_LEN, True)} AS ids FROM enc2)")
    sel = " UNION ALL ".join(f"SELECT id, '{m}' AS model, view, {'round' if digits else ''}({_lin_sql('ids', m)}{digits}) AS toxic FROM views"
                             for m in MD.LINEAR_SCORERS)
    return X.with_fixtures(sel, "comments", ctes=_BASE + ",\n" + clean)


@query("m03_scoring_matrix", _m3_sql())
def m03_scoring_matrix(spark, sf):
    """Scorers x views -> one long score table, written partitioned by model."""
    path = scratch_path(spark, "scores_long")
    view_scores(spark, sf).withColumn("toxic", r6("toxic")).write.mode("overwrite").partitionBy("model").parquet(path)
    return spark.read.parquet(path).select("id", "model", "view", "toxic")


def view_scores(spark, sf, models=tuple(MD.LINEAR_SCORERS)):
    """``id, model, view, toxic``: the text as it is and cleaned, both encoded in one pass and
    scored by all models in one projection. The cleaned text (T8) is a column that both views read, so it is made once."""
    from glossa.plans.q_tokens import MAX_LEN, VOCAB_SIZE, vocabulary
    c = X.comments(spark, sf).select("id", T.clean_text("comment_text").alias("_c"))
    toks = F.explode(F.array(F.struct(F.lit("orig").alias("view"), K.blank_tokens("_c").alias("toks")),
                             F.struct(F.lit("clean").alias("view"), K.word_tokens(T.py_strip(T.dedupe_sentences("_c"))).alias("toks"))))
    views = c.select("id", toks.alias("_v")).select("id", "_v.view", "_v.toks")
    enc = V.encode_ids(views, "id", "toks", vocabulary(spark, sf), carry=["view"], vocab_size=VOCAB_SIZE, max_tokens=MAX_LEN - 2)
    enc = enc.select("id", "view", K.with_marks("raw_ids", MAX_LEN, True).alias("ids"))
    scores = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), MD.linear_score("ids", m).alias("toxic")) for m in models]))
    return enc.select("id", "view", scores.alias("_s")).select("id", "_s.model", "view", "_s.toxic")


def _m4_sql():
    from glossa.plans.q_tokens import _SPLIT, _sql
    return _sql(f"SELECT id, round(max({_lin_sql('input_ids', 'lin_a')}), 6) AS toxic FROM wins GROUP BY id", _SPLIT)


@query("m04_window_max", _m4_sql())
def m04_window_max(spark, sf):
    """Encode, split into windows (K3), score every window, maximum per document (A1)."""
    from glossa.plans.q_tokens import split_windows
    w = split_windows(spark, sf).select("id", MD.linear_score("input_ids", "lin_a").alias("toxic"))
    return E.doc_max(w).select("id", r6("toxic").alias("toxic"))


@query("m05_view_mean", "SELECT id, round(avg(toxic), 6) AS toxic FROM (" + _m3_sql("") + ") WHERE model = 'lin_a' GROUP BY id")
def m05_view_mean(spark, sf):
    """Score every view of a document, mean per document (A2)."""
    return E.doc_mean(view_scores(spark, sf, ["lin_a"])).select("id", r6("toxic").alias("toxic"))


def training_rows(spark, sf):
    """All tokenised comments, and the rows to train on: labelled comments (weight 1) plus
    pseudo-labelled ones (weight 0.5)."""
    from glossa.plans.q_tokens import tokenised
    t = materialize(tokenised(spark, sf))
    lab = t.where(F.col("toxic").isNotNull()).select("id", "lang", "toks", F.col("toxic").cast("double").alias("label"),
                                                     F.lit(1.0).alias("w"))
    sc = X.scores(spark, sf).where(F.col("model") == "m0").select("id", F.col("toxic").alias("p"))
    pseudo = (t.where(F.col("toxic").isNull()).join(sc, "id")
              .select("id", "lang", "toks", L.binarise(L.round1("p"), 0.5).cast("double").alias("label"), F.lit(0.5).alias("w")))
    return t, lab.unionByName(pseudo)


@query("m01_train_classifier", None)
def m01_train_classifier(spark, sf):
    """Train on labelled and pseudo-labelled comments, pick regularisation by validation AUC, score
    every comment."""
    t, rows = training_rows(spark, sf)
    model, auc = MD.train_classifier(rows, "toks", "label", "w")
    scored = MD.predict(model, t.select("id", "toks"))
    return scored.select("id", r6("toxic").alias("toxic"), F.round(F.lit(auc), 6).alias("validation_auc"))


FOLDS = tuple(range(S.N_FOLDS))                   # all folds of G4
MONO_LANGS = tuple(lang for lang, _ in X.VIEW_LANGS)
VARIANTS = tuple(f"fold_{f}" for f in FOLDS) + tuple(f"mono_{x}" for x in MONO_LANGS)


def variant_scores(spark, sf):
    """``id, variant, toxic, auc``: one model per fold (all positives, a tenth of the negatives: G4), which scores all comments,
    and one per language, which scores the comments of its language. First stage: labelled and pseudo-labelled rows (weight
    one half); second stage: labelled rows only, from the weights of the first. The fold of a negative is its place in
    the seeded order of its language, so one ordering serves all folds."""
    t, rows = training_rows(spark, sf)
    placed = S.shuffle_positions(rows, "id", S.SEED, ["lang", "label"], out="_rn").select("id", "label", "w", "_rn")
    held = S.holdout_split(rows, "id").select("id", (F.col("split") == "holdout").alias("holdout"))
    d = t.select("id", "lang", "toks").join(placed, "id", "left").join(held, "id", "left")
    train = {f"fold_{f}": (F.col("label") == 1) | (F.pmod(F.col("_rn") - 1, F.lit(S.N_FOLDS)) == f) for f in FOLDS}
    mono = {f"mono_{x}": F.col("lang") == x for x in MONO_LANGS}
    table = VR.feature_table(d.withColumn("holdout", F.coalesce("holdout", F.lit(False))), ["id", "label", "w", "holdout"], "toks",
                             train | mono, {"all": F.lit(True), "labelled": F.col("w") == 1.0},
                             {f"fold_{f}": F.lit(True) for f in FOLDS} | mono)
    weights, auc = VR.train_staged(table, VARIANTS, 2)
    found = F.create_map(*[F.lit(x) for n, a in auc.items() for x in (n, float("nan") if a is None else float(a))])
    return VR.scores(table, ["id"], weights, VARIANTS).withColumn("auc", F.nanvl(found[F.col("variant")], F.lit(None).cast("double")))


@query("m06_train_variants", X.with_fixtures(
    " UNION ALL ".join([f"SELECT id, 'fold_{f}' AS variant, true AS in_range FROM comments" for f in FOLDS]
                       + ["SELECT id, 'mono_' || lang AS variant, true AS in_range FROM comments WHERE lang IN ("
                          + ", ".join(f"'{x}'" for x in MONO_LANGS) + ")"]), "comments"))
def m06_train_variants(spark, sf):
    """The rows and the range of ``variant_scores``, which is what SQL can check."""
    return variant_scores(spark, sf).select("id", "variant", F.col("toxic").between(0.0, 1.0).alias("in_range"))


@query("m07_variant_scores", None)
def m07_variant_scores(spark, sf):
    """The scores of all ten folds and four languages with the validation AUC of each model."""
    s = variant_scores(spark, sf)
    return s.select("id", "variant", r6("toxic").alias("toxic"), F.round("auc", 6).alias("validation_auc"))


EXTERNAL_LEN = 512


def load_external_scorer(name="lin_b"):
    """Stands for a model file: the scorer of ``name`` over a padded matrix of ids with a mask, in numpy."""
    def load():
        import numpy as np
        import pandas as pd
        a, b = MD.LINEAR_SCORERS[name]

        def score(batch):
            sizes = batch["ids"].map(len).to_numpy()
            ids = np.full((len(batch), sizes.max()), K.PAD, np.int64)
            for row, x in zip(ids, batch["ids"]):
                row[:len(x)] = x
            mask = np.arange(ids.shape[1]) < sizes[:, None]
            total = (((ids * a + b) % 101 - 50) * mask).sum(axis=1)
            return pd.Series(1.0 / (1.0 + np.exp(-(total / 1000.0))))
        return score
    return load


def _m8_sql():
    from glossa.plans.q_tokens import _sql, marks_sql
    a, b = MD.LINEAR_SCORERS["lin_b"]
    total = f"list_sum(list_transform({marks_sql('raw_ids', EXTERNAL_LEN, False)}, lambda x: (x * {a} + {b}) % 101 - 50))"
    return _sql(f"SELECT id, round(1.0 / (1.0 + exp(-(CAST({total} AS DOUBLE) / CAST(1000 AS DOUBLE)))), 6) AS toxic FROM enc")


@query("m08_external_scorer", _m8_sql())
def m08_external_scorer(spark, sf):
    """A user's scorer over padded batches of like length; the texts keep their own length."""
    from glossa.plans.q_tokens import encoded
    e = encoded(spark, sf, EXTERNAL_LEN - 2).select("id", K.with_marks("raw_ids", EXTERNAL_LEN, False).alias("ids"))
    scored = BT.apply_in_batches(e, "lin_b", load_external_scorer(), "toxic", "double", F.size("ids"))
    return scored.select("id", r6("toxic").alias("toxic"))


def _m9_sql():
    from glossa.plans import sqlkit as Q
    return X.with_fixtures(f"SELECT id, {Q.strip_digits_quotes('comment_text')} AS comment_text FROM comments", "comments")


def load_user_cleaner():
    """Stands for a user's own cleaner in Python."""
    import re
    pattern = re.compile(T.DIGITS_QUOTES)
    return lambda batch: batch["comment_text"].map(lambda x: None if x is None else pattern.sub("", x))


@query("f01_user_cleaner", _m9_sql())
def f01_user_cleaner(spark, sf):
    """F1: a cleaner that is no column expression, through the same batches as a scorer."""
    c = X.comments(spark, sf).select("id", "comment_text")
    return BT.apply_in_batches(c, "digits_quotes", load_user_cleaner, "cleaned", "string", F.length("comment_text"), cells=1 << 24).select(
        "id", F.col("cleaned").alias("comment_text"))
