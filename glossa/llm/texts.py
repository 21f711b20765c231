"""Words and byte buffers of texts, inside Spark tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from glossa.llm.segments import BASE, BYTE_HASH, _powers, mix

# --- fixed values: the separators of words -------------------------------------
SEPARATORS = b" \t\n\x0b\x0c\r"
WORD_SPLIT = "[\\x20\\x09-\\x0D]+"
# ------------------------------------------------------------------------------
_IS_SEPARATOR = np.zeros(256, bool)
_IS_SEPARATOR[list(SEPARATORS)] = True
_PIECE = 1 << 20           # bytes of a long text hashed at once


def utf8_column(batch: pa.RecordBatch, name: str) -> Iterator[memoryview]:
    """The UTF-8 bytes of each text of a string column without copying; null is empty."""
    column = batch.column(name)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = memoryview(column.buffers()[2] or b"")
    empty = memoryview(b"")
    known = column.is_valid().to_numpy(zero_copy_only=False)
    for i in range(len(column)):
        yield data[offsets[i]:offsets[i + 1]] if known[i] else empty


def word_bounds(text) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets at which each word starts and ends."""
    gap = _IS_SEPARATOR[np.frombuffer(text, np.uint8)]
    edge = np.flatnonzero(np.diff(gap, prepend=True, append=True))
    return edge[0::2], edge[1::2]


def word_hashes(text) -> np.ndarray:
    """A 64-bit hash of every word of a text."""
    return hashes_between(text, *word_bounds(text))


def hashes_between(text, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes from each start to its end; both rise."""
    out = np.empty(len(starts), np.uint64)
    raw = np.frombuffer(text, np.uint8)
    done = 0
    while done < len(starts):             # whole words of about _PIECE bytes
        a = starts[done]
        upto = max(done + 1, int(np.searchsorted(ends, a + _PIECE, "right")))
        b = ends[upto - 1]
        power, inverse = _powers(int(b - a) + 1)
        prefix = np.zeros(b - a + 1, np.uint64)
        np.cumsum(BYTE_HASH[raw[a:b]] * power[:b - a], out=prefix[1:])
        s, e = starts[done:upto] - a, ends[done:upto] - a
        out[done:upto] = mix((prefix[e] - prefix[s]) * inverse[s] + (e - s).astype(np.uint64) * np.uint64(BASE))
        done = upto
    return out
