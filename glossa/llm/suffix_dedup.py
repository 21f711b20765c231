"""Operator 6, suffix-array dedup: removes bytes inside long strings that occur earlier in the corpus.

Method: not prefix doubling, but the super-k-mer partitioning of operator 1 (``repeats``) with bytes
for words: super-k-mers by minimiser, then windows of ``width`` bytes named by two 64-bit hashes of their
halves and sorted once. There is no rank table, no reranking and no growing offset.

Defined results: a null or empty text has no bytes; matches never cross documents; a null
id counts as larger than all ids; rows that share an id are ordered by a checksum of the text;
equal rows count as one document and get equal results; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.repeats import Unit, covered, keyed, repeated_windows, with_spans
from glossa.llm.texts import utf8_column

MATCH_BYTES = 100
GRAM_BYTES = 24


def dedup_suffixes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   width: int = MATCH_BYTES) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept`` per row of ``docs``: a byte goes if a string of
    ``width`` bytes that covers it also starts earlier (smaller id, or earlier in the same
    document). ``kept`` (binary, since a cut may split a character) holds the rest."""
    unit = Unit(words=False, width=width, gram=min(GRAM_BYTES, width), by_document=False)
    rows = keyed(docs, id_col, text_col)
    out = with_spans(rows, repeated_windows(rows, unit)).select("id", "text", "spans").mapInArrow(
        _remove(unit), "id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.withColumnRenamed("id", id_col)


def _remove(unit: Unit):
    def run(batches):
        for batch in batches:
            spans = batch.column("spans").to_pylist()
            counts, kept = [], []
            for text, runs in zip(utf8_column(batch, "text"), spans):
                gone = pieces = 0
                rest = bytes(text)
                if runs:
                    mask = covered(runs, len(text), unit.width)
                    gone, pieces = int(mask.sum()), int((np.diff(mask.astype(np.int8), prepend=0) == 1).sum())
                    rest = np.frombuffer(text, np.uint8)[~mask].tobytes()
                counts.append((len(text), gone, pieces))
                kept.append(rest)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array([c[k] for c in counts], pa.int64()) for k in range(3)),
                 pa.array(kept, pa.binary())], names=["id", "n_bytes", "n_removed", "n_spans", "kept"])
    return run


def digest(result: DataFrame) -> DataFrame:
    """The columns of the query: the kept bytes as a SHA-256."""
    return result.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


#: DuckDB SQL of the query for tables whose ids are unique and known
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
starts AS (SELECT doc_id, b, unnest(range(1, octet_length(b) - {MATCH_BYTES - 2})) AS i FROM d WHERE octet_length(b) >= {MATCH_BYTES}),
windows AS (SELECT doc_id, i, array_slice(b, i, i + {MATCH_BYTES - 1}) AS x FROM starts),
earliest AS (SELECT x, min(struct_pack(o := doc_id, i := i)) AS f FROM windows GROUP BY x HAVING count(*) > 1),
hits AS (SELECT w.doc_id, w.i FROM windows w JOIN earliest USING (x) WHERE struct_pack(o := w.doc_id, i := w.i) > f),
steps AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {MATCH_BYTES} THEN 0 ELSE 1 END AS opens FROM hits),
runs AS (SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM steps),
spans AS (SELECT doc_id, min(i) AS a, max(i) + {MATCH_BYTES} AS z FROM runs GROUP BY doc_id, r),
gaps AS (SELECT doc_id, a, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 1) AS since FROM spans),
cut AS (SELECT doc_id, sum(z - a) AS n, count(*) AS m, max(z) AS z FROM spans GROUP BY doc_id),
before AS (SELECT g.doc_id, string_agg(hex(array_slice(b, since, a - 1)), '' ORDER BY a) AS h FROM gaps g JOIN d USING (doc_id) GROUP BY g.doc_id)
SELECT d.doc_id, octet_length(b) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, coalesce(m, 0) AS n_spans,
  sha256(unhex(coalesce(h, '') || hex(array_slice(b, coalesce(z, 1), octet_length(b))))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id) LEFT JOIN before USING (doc_id)"""
