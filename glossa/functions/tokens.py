"""Token-array column functions (K1, K3-K8).

Token ids follow one convention: begin = 0, pad = 1, end = 2, unknown = 3,
vocabulary ids from 4 (see ``glossa.operators.vocab``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glossa.functions import rand
from glossa.functions import text as T

# --- fixed values ------------------------------------------------------------
BOS, PAD, EOS, UNK = 0, 1, 2, 3
MASK_ID = 250001          # mask token (last id of the pretrained vocabulary)
RANDOM_ID_RANGE = (3, 250001)
MLM_SELECT_P = 0.15
MLM_MASK_P = 0.90
MLM_RANDOM_P = 1.0 / 9.0
# -----------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def word_tokens(c) -> Column:
    """Blank-separated tokens of the cleaned text (T8), empty pieces dropped."""
    return blank_tokens(T.clean_text(c))


def blank_tokens(cleaned) -> Column:
    """Blank-separated tokens of a text that is cleaned already."""
    return F.array_remove(F.split(_c(cleaned), " ", -1), "")


def with_marks(raw_ids, max_len: int, pad: bool) -> Column:            # K1 / K5
    """``[BOS] + ids[:max_len-2] + [EOS]``, right-padded with PAD to ``max_len``."""
    body = F.slice(_c(raw_ids), 1, max_len - 2)
    ids = F.concat(F.array(F.lit(BOS)), body, F.array(F.lit(EOS)))
    if not pad:
        return ids
    return F.concat(ids, F.array_repeat(F.lit(PAD), F.lit(max_len) - F.size(ids)))


def window_starts(ids, max_len: int, window: int) -> Column:          # K3
    """Start offsets (into the content ids[1:-1]) of the sliding windows.

    Windows of ``max_len - 2`` content ids begin at 0, window, 2*window, ... and
    stop at the first window that reaches the end of the content."""
    n_content = F.size(_c(ids)) - F.lit(2)
    last = F.greatest(F.lit(0), F.ceil((n_content - F.lit(max_len - 2)) / F.lit(float(window))))
    return F.transform(F.sequence(F.lit(0), last.cast("int")), lambda k: k * F.lit(window))


def window_ids(ids, start, max_len: int) -> Column:                   # K3
    """Re-marked, padded window of the content starting at ``start``; ids shorter
    than ``max_len`` are only padded."""
    content = F.slice(_c(ids), 2, F.size(_c(ids)) - 2)
    win = F.concat(F.array(F.lit(BOS)), F.slice(content, _c(start) + 1, max_len - 2), F.array(F.lit(EOS)))
    short = F.size(_c(ids)) < F.lit(max_len)
    chosen = F.when(short, _c(ids)).otherwise(win)
    return F.concat(chosen, F.array_repeat(F.lit(PAD), F.lit(max_len) - F.size(chosen)))


def attention_mask(ids) -> Column:                                      # K6
    return F.transform(_c(ids), lambda x: F.when(x != F.lit(PAD), F.lit(1)).otherwise(F.lit(0)))


def token_length(ids) -> Column:                                        # K6
    return F.aggregate(attention_mask(ids), F.lit(0), lambda acc, x: acc + x)


def one_hot(label) -> Column:                                           # K8
    y = _c(label).cast("double")
    return F.array(F.lit(1.0) - y, y)


def mlm_draws(ids, key, seed: int = 0, mask_id: int = MASK_ID, random_ids: tuple[int, int] = RANDOM_ID_RANGE) -> Column:
    """The input id of each selected position, null where none is selected: see ``mlm_inputs_and_labels``."""
    def below(p, i, tag):
        return rand.uniform_below(p, seed, key, i, tag)

    lo, hi = random_ids
    rid = lambda i: (F.floor(rand.uniform(seed, key, i, "rid") * F.lit(hi - lo)) + F.lit(lo)).cast("int")

    def drawn(x, i):
        masked = F.when(below(MLM_RANDOM_P, i, "rnd"), rid(i)).otherwise(F.lit(mask_id))
        return F.when((x > F.lit(EOS)) & below(MLM_SELECT_P, i, "sel"), F.when(below(MLM_MASK_P, i, "mask"), masked).otherwise(x))
    return F.transform(_c(ids), drawn)


def mlm_inputs_and_labels(ids, key, seed: int = 0, mask_id: int = MASK_ID, random_ids: tuple[int, int] = RANDOM_ID_RANGE,
                          draws=None) -> tuple[Column, Column]:   # K7
    """Masked-LM inputs and labels. Each position draws three md5 uniforms keyed by
    (seed, key, position): select (15 %, ids > 2 only), mask (90 % of selected),
    random id (1/9 of masked). ``mask_id`` and ``random_ids`` (from, below) belong to the
    vocabulary; the defaults are the pretrained one's. Labels are the id where selected, else -1.
    ``draws``: a column that holds ``mlm_draws``, so they are made once for both."""
    new = mlm_draws(ids, key, seed, mask_id, random_ids) if draws is None else _c(draws)
    inputs = F.zip_with(_c(ids), new, lambda x, n: F.coalesce(n, x))
    labels = F.zip_with(_c(ids), new, lambda x, n: F.when(n.isNotNull(), x).otherwise(F.lit(-1)))
    return inputs, labels
