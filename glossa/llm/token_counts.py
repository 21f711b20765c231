"""Operator 2, token counts: greedy longest-match word-piece lengths without building pieces.

Method: a linear longest-match automaton. The vocabulary trie gets failure links, and
every link holds the precomputed number of pieces it pops, so a word is one pass over its
bytes. The vocabulary is a public byte-level token table (``<base64 token> <rank>`` a
line), built into the automaton on the driver and broadcast: at most ``MAX_VOCABULARY``
tokens, larger files are refused. It holds all single bytes, so every word has pieces.

A word is a maximal run of other characters than ASCII blanks, read with one leading
space, as the vocabulary's word-initial tokens are.

Defined results: a null, empty or blank text has 0 words and 0 tokens; null ids are kept as
they are; equal rows get equal results; other columns are ignored.
"""

from __future__ import annotations

import base64
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from glossa.llm.texts import utf8_column

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
MAX_VOCABULARY = 1_000_000
CACHE_WORDS = 200_000       # word lengths a task remembers; only saves time


def read_vocabulary(spark: SparkSession, path: str) -> list[bytes]:
    """The tokens of a table; read through Spark, so any store that Spark reads will do."""
    if "://" not in path and os.path.exists(path):
        path = "file://" + os.path.abspath(path)
    lines = spark.read.text(path).limit(MAX_VOCABULARY + 1).collect()
    if len(lines) > MAX_VOCABULARY:
        raise ValueError(f"{path}: more than {MAX_VOCABULARY} tokens")
    return [base64.b64decode(r[0].split()[0]) for r in lines if r[0].strip()]


class Automaton:
    """Trie of the tokens: ``goto`` maps node * 256 + byte to a node, ``fail`` the node to go on
    from when no edge fits, ``popped`` the pieces completed by doing so."""

    def __init__(self, tokens: list[bytes]):
        tokens = {t for t in tokens if t}
        missing = [b for b in range(256) if bytes([b]) not in tokens]
        if missing:
            raise ValueError(f"vocabulary lacks the single bytes {missing[:5]}")
        goto: dict[int, int] = {}
        parent, byte, final = [0], [0], [False]
        for t in tokens:
            node = 0
            for b in t:
                nxt = goto.get(node << 8 | b)
                if nxt is None:
                    nxt = goto[node << 8 | b] = len(parent)
                    parent.append(node)
                    byte.append(b)
                    final.append(False)
                node = nxt
            final[node] = True
        depth = np.zeros(len(parent), np.int64)
        for v in range(1, len(parent)):           # a parent is always numbered before its child
            depth[v] = depth[parent[v]] + 1
        fail, popped = [0] * len(parent), [0] * len(parent)
        for v in map(int, np.argsort(depth, kind="stable")[1:]):
            if final[v]:                          # a whole token: one piece, start afresh
                popped[v] = 1
                continue
            z, n = fail[parent[v]], popped[parent[v]]
            while (nxt := goto.get(z << 8 | byte[v])) is None:
                n += popped[z]
                z = fail[z]
            fail[v], popped[v] = nxt, n
        self.goto, self.fail, self.popped = goto, fail, popped

    def pieces(self, word: bytes) -> int:
        goto, fail, popped = self.goto, self.fail, self.popped
        node = n = 0
        for b in word:
            while (nxt := goto.get(node << 8 | b)) is None:
                n += popped[node]
                node = fail[node]
            node = nxt
        while node:
            n += popped[node]
            node = fail[node]
        return n


class _Lengths(dict):
    """Pieces of the words seen so far, at most ``CACHE_WORDS`` of them."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        n = self[word] = self.automaton.pieces(b" " + word)
        return n


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str = VOCABULARY) -> DataFrame:
    """``id, n_words, n_tokens`` per row of ``docs``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Automaton(read_vocabulary(spark, vocabulary)))

    def run(batches):
        lengths = _Lengths(shared.value)
        for batch in batches:
            n_words, n_tokens = [], []
            for text in utf8_column(batch, "text"):
                words = bytes(text).split()
                n_words.append(len(words))
                n_tokens.append(sum(map(lengths.__getitem__, words)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())],
                names=["id", "n_words", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_words long, n_tokens long").withColumnRenamed("id", id_col)
