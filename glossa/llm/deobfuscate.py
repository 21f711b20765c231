"""Noisy-channel restoration of disguised words.

A writer means plain letters; the channel may replace letters by look-alike symbols, put
separators or blanks between them and repeat them. A disguised token is therefore a lattice:
at each character, the letters it may stand for, itself, or nothing. The Viterbi path under a
character language model (trigrams over all texts) and the channel's costs is the restored word.

Tokens of letters only without a letter three times in a row have one path and are not decoded.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.texts import utf8_column

# --- fixed values: letters that a symbol may stand for ------------------------------
LOOK_ALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a",
               "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "*": "aeiou", "#": "h", "€": "e", "£": "l"}
SEPARATORS = " \t.-_*'~/·​‌‍­"
# ------------------------------------------------------------------------------------
#: costs of the channel, as negative natural logarithms
STANDS_FOR, SPACED, REPEATED, DOUBLED, KEPT = 1.0, 0.5, 0.2, 3.0, 2.0
SIZE = 64                  # classes of characters: 0 is the edge of a word
_EDGE = ".,;:?!\"'()[]{}<>«»…*#%&|/\\~^`=+_-–—·“”„’‘"
_TRIPLE = re.compile(r"(.)\1\1")
_DECORATION = re.compile(r"^([$@])\1\1+|([$@])\2\2+$")
_SLICE = 1 << 20           # characters counted at once


def _class_table(size: int = 0x3000) -> np.ndarray:
    table = np.zeros(size, np.uint8)
    for code in range(size):
        c = chr(code)
        if "a" <= c <= "z":
            table[code] = code - 96
        elif 0xDF <= code <= 0xFF and c.isalpha():
            table[code] = code - 0xDF + 27
        elif c.isalpha():
            table[code] = 60
        elif c.isdigit():
            table[code] = 61
    return table


CLASSES = _class_table()


def class_of(c: str) -> int:
    code = ord(c)
    return int(CLASSES[code]) if code < len(CLASSES) else 60 if c.isalpha() else 0


def _count(batches):
    """Trigrams of character classes of all texts of a task."""
    total = np.zeros(SIZE ** 3, np.int64)

    def add(text):
        for start in range(0, len(text), _SLICE):
            code = np.frombuffer((" " + text[max(0, start - 2):start + _SLICE] + " ").encode("utf-32-le", "replace"), np.uint32)
            c = np.where(code < len(CLASSES), CLASSES[np.minimum(code, len(CLASSES) - 1)], 60).astype(np.int64)
            if start:
                c = c[1:]                            # the edge was put before a slice in the middle of a text
            if start + _SLICE < len(text):
                c = c[:-1]
            if len(c) > 2:
                total[:] += np.bincount(c[:-2] * SIZE * SIZE + c[1:-1] * SIZE + c[2:], minlength=SIZE ** 3)
    for batch in batches:
        held, size = [], 0
        for text in utf8_column(batch, "text"):
            held.append(str(text, "utf-8", "replace").lower())
            size += len(held[-1])
            if size > _SLICE:
                add(" ".join(held))
                held, size = [], 0
        add(" ".join(held))
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found])], names=["gram", "f"])


def character_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Trigram counts over every whole text, summed by Spark; at most ``SIZE ** 3`` rows reach the driver."""
    rows = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    counts = np.zeros(SIZE ** 3)
    for r in rows.mapInArrow(_count, "gram int, f long").groupBy("gram").agg(F.sum("f").alias("f")).collect():
        counts[r["gram"]] = r["f"]
    return counts.reshape(SIZE, SIZE, SIZE)


class LanguageModel:
    """Interpolated trigram log-probabilities of character classes (1 MB)."""

    def __init__(self, counts: np.ndarray):
        uniform = 1.0 / SIZE
        one = counts.sum(axis=(0, 1))
        p = (one + 1) / (one.sum() + SIZE)
        for grams in (counts.sum(axis=0), counts):                      # weight of a context grows with its frequency
            seen = grams.sum(axis=-1, keepdims=True)
            kinds = (grams > 0).sum(axis=-1, keepdims=True) + 1
            p = (grams + kinds * p) / (seen + kinds)
        self.log = np.log(0.999 * p + 0.001 * uniform).astype(np.float32)
        self._rows = None

    def __getstate__(self):
        return {"log": self.log, "_rows": None}

    def rows(self) -> list:
        if self._rows is None:
            self._rows = self.log.tolist()
        return self._rows


def is_plain(token: str) -> bool:
    return token.isalpha() and not _TRIPLE.search(token)


def core(token: str) -> str:
    """A token without punctuation at its ends and without rows of three and more $ or @ there."""
    while True:
        shorter = _DECORATION.sub("", token.strip(_EDGE))
        if shorter == token:
            return token
        token = shorter


def _options(text: str):
    """For each character: pairs of what was meant (empty: nothing) and the cost."""
    i = 0
    while i < len(text):
        c = text[i]
        run = 1
        while i + run < len(text) and text[i + run] == c:
            run += 1
        for k in range(run):
            if c.isalpha():
                options = [(c, 0.0 if k < 2 else KEPT)]
                if k:
                    options.append(("", REPEATED if run > 2 else DOUBLED))
            else:
                options = [(c, KEPT if c in " \t" else 0.0)]        # who writes letters apart means few of the blanks
                options += [(letter, STANDS_FOR) for letter in LOOK_ALIKES.get(c, "")]
                if c in SEPARATORS:
                    options.append(("", SPACED))
                elif k:
                    options.append(("", REPEATED if run > 2 else DOUBLED))
            yield options
        i += run


def decode(text: str, model: LanguageModel) -> str:
    """The most likely meant text of a lower-case token (or of letters with blanks between).
    A state is the classes of the last two characters: a handful at a time, so time grows with length."""
    rows = model.rows()
    states = {(0, 0): (0.0, None)}
    for options in _options(text):
        step: dict = {}
        for letter, cost in options:
            k = class_of(letter) if letter else -1
            for (a, b), (score, path) in states.items():
                if letter:
                    new, total = (b, k), score + rows[a][b][k] - cost
                    if k == 0 and b == 0:
                        new, total = (a, b), score - cost
                    path2 = (path, letter)
                else:
                    new, total, path2 = (a, b), score - cost, path
                got = step.get(new)
                if got is None or total > got[0]:
                    step[new] = (total, path2)
        states = step
    _, path = max(((s + (rows[a][b][0] if b else 0.0), p) for (a, b), (s, p) in states.items()), key=lambda x: x[0])
    out = []
    while path:
        path, letter = path
        out.append(letter)
    return "".join(reversed(out))


def words_of(token: str, model: LanguageModel) -> list[str]:
    """Restored words of one lower-case token: letters only."""
    if is_plain(token):
        return [token]
    inner = core(token)
    if is_plain(inner):
        return [inner]
    if not any(map(str.isalpha, inner)):
        return []
    return [w for w in re.split(r"[\W\d_]+", decode(inner, model)) if w]


#: three or more single letters or look-alikes with blanks between
SPACED_LETTERS = re.compile(r"(?<!\S)(?:[^\W_]|[@$!|+(<*])(?:[ \t]+(?:[^\W_]|[@$!|+(<*])){2,}(?!\S)")


def spaced_words(text: str, model: LanguageModel) -> list[str]:
    """Restored words of letters written apart in a lower-case text."""
    out = []
    for m in SPACED_LETTERS.finditer(text):
        if any(map(str.isalpha, m.group())):
            out += [w for w in re.split(r"[\W\d_]+", decode(m.group(), model)) if len(w) > 2]
    return out


def restore(text: str, model: LanguageModel) -> str:
    """A text with its disguised tokens restored; plain tokens and white space stay as they are."""
    def apart(m):
        return decode(m.group().lower(), model) if any(map(str.isalpha, m.group())) else m.group()

    def single(m):
        token = m.group()
        inner = core(token.lower())
        if is_plain(token.lower()) or is_plain(inner) or not any(map(str.isalpha, inner)):
            return token
        return decode(inner, model)
    return re.sub(r"\S+", single, SPACED_LETTERS.sub(apart, text))
