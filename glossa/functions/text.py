"""Text cleaning column functions.

All of them are native Spark expressions (regexp_replace / split / transform),
so they stay inside whole-stage code generation and never start a Python
worker. The patterns are written so that Java regex (Spark) and RE2 (the SQL
oracle) give the same answer as Python's ``re`` with Unicode strings.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ------------------------------------------------------------
# Python's \s over the whole BMP, spelled so that Java regex and RE2 agree.
WS = r"[\s\p{Z}\x0b\x1c-\x1f\x85]"
# Python's \S (complement of WS).
NON_WS = r"[^\s\p{Z}\x0b\x1c-\x1f\x85]"
# A run of blanks that is not a single " " already. Printable ASCII, most of a text, is passed over by one comparison.
RUN_TO_COLLAPSE = r"(?![!-~])(?:[\s\p{Z}\x0b\x1c-\x1f\x85&&[^ ]]" + WS + r"*| (?![!-~])" + WS + "+)"
# A text as blanks, the rest up to the last non-blank, and blanks.
STRIPPED = "(?s)^" + WS + "*(.*" + NON_WS + ")?" + WS + r"*\z"
# Python's \w.
WORD = r"[\p{L}\p{N}_]"
# Characters removed by the basic cleaner: ASCII digits and double quotes.
DIGITS_QUOTES = r'[0-9"]'
DIGITS = r"[0-9]"
# '#' / '@' followed by non-blanks up to a word boundary (= ends in a word char).
HASHTAG = "#" + NON_WS + "*" + WORD
MENTION = "@" + NON_WS + "*" + WORD
URL = "https?" + NON_WS + "+"
# Dotted quad of 1-3 decimal digits each, unanchored.
IPV4 = r"\p{Nd}{1,3}\.\p{Nd}{1,3}\.\p{Nd}{1,3}\.\p{Nd}{1,3}"
# Template (bot) message markers.
BOT_PREFIX = "Bonjour,"
BOT_SUFFIXES = ("(bot de maintenance)", "Salebot (d)")
# Sentence break: a stop mark followed by blanks.
SENTENCE_BREAK = "([.!?])" + WS + "+"
SENTENCE_SEP = "\u0001"
# -----------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_digits_quotes(c) -> Column:        # T1
    return F.regexp_replace(_c(c), DIGITS_QUOTES, "")


def strip_hashtags(c) -> Column:             # T2
    return F.regexp_replace(_c(c), HASHTAG, "")


def strip_mentions(c) -> Column:             # T3
    return F.regexp_replace(_c(c), MENTION, "")


def strip_urls(c) -> Column:                 # T4
    return F.regexp_replace(_c(c), URL, "")


def collapse_ws(c) -> Column:                # T5
    return F.regexp_replace(_c(c), RUN_TO_COLLAPSE, " ")


def strip_numbers(c) -> Column:              # T6
    return collapse_ws(F.regexp_replace(_c(c), DIGITS, ""))


def py_strip(c) -> Column:                   # T7
    """``str.strip()``: remove Unicode whitespace at both ends."""
    return F.regexp_replace(_c(c), STRIPPED, "$1")


def clean_text(c) -> Column:                 # T8
    """Digits/quotes, hashtags, mentions, URLs removed; blanks collapsed; not trimmed."""
    return collapse_ws(strip_urls(strip_mentions(strip_hashtags(strip_digits_quotes(c)))))


def sentences(c) -> Column:                  # T9
    """Split after ``.``, ``!`` or ``?`` followed by blanks -> array<string>."""
    marked = F.regexp_replace(_c(c), SENTENCE_BREAK, "$1" + SENTENCE_SEP)
    return F.split(marked, SENTENCE_SEP, -1)


def dedupe_sentences(c, pieces=None) -> Column:           # T10
    """Trimmed sentences, each kept at its first occurrence, joined by one blank. ``pieces``: an array of
    sentences split otherwise (``operators.sentences``), in place of T9's split of ``c``."""
    trimmed = F.transform(sentences(c) if pieces is None else _c(pieces), lambda s: py_strip(s))
    return F.array_join(F.array_distinct(trimmed), " ")


def clean_text_mono(c, pieces=None) -> Column:            # T11
    """``pieces``: the sentences of the cleaned text (T8), if split otherwise than by T9."""
    return py_strip(dedupe_sentences(clean_text(c), pieces))


def has_ipv4(c) -> Column:                   # T12
    return F.when(_c(c).rlike(IPV4), F.lit(1)).otherwise(F.lit(0))


def is_template_message(c) -> Column:        # T13
    t = py_strip(c)
    ends = t.endswith(BOT_SUFFIXES[0])
    for s in BOT_SUFFIXES[1:]:
        ends = ends | t.endswith(s)
    return F.coalesce(t.startswith(BOT_PREFIX) & ends, F.lit(False))


def composite_key(*parts) -> Column:         # T14
    """``str(a) + str(b)``; doubles print as Python does for one-decimal labels."""
    return F.concat(*[_c(p).cast("string") for p in parts])
