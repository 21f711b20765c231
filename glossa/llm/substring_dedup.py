"""Operator 1, substring dedup: removes words inside long passages that an earlier document has.

Method: super-k-mer partitioning (``repeats``). Consecutive 13-word windows that share a
minimiser travel as one packed string to the minimiser's bucket, where sorting
finds equal windows.

Defined results: a null or empty text has no words; a text shorter than a window
loses nothing; a null id counts as larger than all ids; rows that share an id are
judged each on its own and none counts as earlier than another; equal rows get equal
results; other columns of the input are ignored.
"""

from __future__ import annotations

from itertools import compress

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.repeats import Unit, covered, keyed, repeated_windows, with_spans
from glossa.llm.texts import utf8_column

WINDOW_WORDS = 13
GRAM_WORDS = 4             # words in a minimiser


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     width: int = WINDOW_WORDS) -> DataFrame:
    """``id, n_words, n_removed, kept`` per row of ``docs``: a word goes if a window of ``width``
    words that covers it also starts in a document with a smaller id. ``kept`` holds the
    remaining words joined by one space."""
    unit = Unit(words=True, width=width, gram=min(GRAM_WORDS, width), by_document=True)
    rows = keyed(docs, id_col, text_col)
    out = with_spans(rows, repeated_windows(rows, unit)).select("id", "text", "spans").mapInArrow(
        _remove(unit), "id long, n_words long, n_removed long, kept string")
    return out.withColumnRenamed("id", id_col)


def _remove(unit: Unit):
    def run(batches):
        for batch in batches:
            spans = batch.column("spans").to_pylist()
            n_words, n_removed, kept = [], [], []
            for text, runs in zip(utf8_column(batch, "text"), spans):
                words = bytes(text).split()
                gone = 0
                n_words.append(len(words))
                if runs:
                    mask = covered(runs, len(words), unit.width)
                    gone = int(mask.sum())
                    words = compress(words, ~mask)
                n_removed.append(gone)
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], names=["id", "n_words", "n_removed", "kept"])
    return run


def digest(result: DataFrame) -> DataFrame:
    """The columns of the query: the kept words as a SHA-256."""
    return result.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: DuckDB SQL of the query for tables whose ids are unique and known
ORACLE_SQL = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - {WINDOW_WORDS - 2})) AS i FROM w WHERE len(ws) >= {WINDOW_WORDS}),
windows AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + {WINDOW_WORDS - 1}), ' ') AS x FROM starts),
earliest AS (SELECT x, min(doc_id) AS o FROM windows GROUP BY x),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW_WORDS})) AS i FROM windows JOIN earliest USING (x) WHERE o < doc_id),
places AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS k FROM places ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM w LEFT JOIN counts USING (doc_id) LEFT JOIN kept USING (doc_id)"""
