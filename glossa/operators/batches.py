"""User functions over Arrow batches of like length (M2, F1).

An external scorer pads its batch to the longest text, so rows are ordered by length inside their
partition (no shuffle) and cut into batches of a bounded number of padded cells. What ``load()``
returns is kept by the worker process under its name: the tasks that a worker runs one after another
load a model once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

BATCH_CELLS = 1 << 18          # rows of a batch times its longest length
BATCH_ROWS = 4_096

_kept: dict[str, Callable] = {}


def kept(name: str, load: Callable[[], Callable]) -> Callable:
    """The function that ``load`` returns, loaded once by this process for each name."""
    if name not in _kept:
        _kept[name] = load()
    return _kept[name]


def cuts(lengths: list[int], cells: int = BATCH_CELLS, rows: int = BATCH_ROWS) -> list[tuple[int, int]]:
    """Ranges of rows, in order, with at most ``rows`` rows and (longest length) * rows <= ``cells``.
    A row longer than ``cells`` is a batch of its own."""
    out, first, longest = [], 0, 0
    for i, n in enumerate(lengths):
        wider = max(longest, n)
        if i > first and (i - first >= rows or wider * (i - first + 1) > cells):
            out.append((first, i))
            first, wider = i, n
        longest = wider
    return out + [(first, len(lengths))] if lengths else out


def apply_in_batches(df: DataFrame, name: str, load: Callable[[], Callable[[pd.DataFrame], pd.Series]], out: str,
                     out_type: str, length: Column | str, cells: int = BATCH_CELLS, rows: int = BATCH_ROWS) -> DataFrame:
    """``df`` with the column ``out``, computed by the function that ``load()`` returns: it takes a pandas
    batch with the columns of ``df`` and returns one value for each row. ``name`` tells models apart (say, the path
    and version). ``length`` is what a batch is padded by; rows without a length count as empty. A column
    named ``out`` is replaced. An empty table gives no rows and loads nothing."""
    columns = [c for c in df.columns if c != out]
    field = StructType.fromDDL(f"`{out}` {out_type}").fields[0]
    schema = StructType([df.schema[c] for c in columns] + [StructField(field.name, field.dataType)])
    size = F.col(length) if isinstance(length, str) else length
    d = df.select(*columns, F.coalesce(size.cast("int"), F.lit(0)).alias("_length")).sortWithinPartitions("_length")

    def run(batches: Iterator[pd.DataFrame]):
        from glossa.operators import batches as here           # the worker's own module keeps the models
        for pdf in batches:
            sizes = pdf.pop("_length").tolist()
            for a, b in here.cuts(sizes, cells, rows):
                part = pdf.iloc[a:b].reset_index(drop=True)
                values = here.kept(name, load)(part)
                if len(values) != b - a:
                    raise ValueError(f"{name} returned {len(values)} values for {b - a} rows")
                yield part.assign(**{out: values})
    return d.mapInPandas(run, schema)
