"""What the document operators share: words, page-sized batches, column names."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Runs of characters other than the six ASCII white-space ones; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have yet, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def chunks(values: list, limit: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Ranges of the list that hold about ``limit`` characters or bytes each.

    A value is never cut, so a longer one is a range of its own.
    """
    start = size = 0
    for at, value in enumerate(values):
        size += len(value or "")
        if size >= limit:
            yield start, at + 1
            start, size = at + 1, 0
    if start < len(values):
        yield start, len(values)


def ragged(flat: np.ndarray, lengths: np.ndarray, of: pa.DataType) -> pa.Array:
    """List column from the values one after another and the length of each row."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, of))


def row_key(id_col: Column, text: Column) -> Column:
    """md5 of id and text, hex: names a row; rows alike in both share it."""
    return F.md5(
        F.concat(
            F.coalesce(id_col.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))
        )
    )


def flat_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts one after another, and the length of each."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    return points, np.fromiter(map(len, texts), np.int64, len(texts))


def sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum of each run of ``lengths`` values."""
    total = np.zeros(len(values) + 1, np.float64)
    np.cumsum(values, out=total[1:])
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]
