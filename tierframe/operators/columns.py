"""Projections, renames, casts and row filters."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def names_except(df: DataFrame, excluded: Iterable[str]) -> list[str]:
    dropped = set(excluded)
    return [c for c in df.columns if c not in dropped]


def names_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def names_matching(df: DataFrame, pattern: str) -> list[str]:
    """Names whose beginning matches the regular expression."""
    matcher = re.compile(pattern)
    return [c for c in df.columns if matcher.match(c)]


def select_except(df: DataFrame, excluded: Iterable[str]) -> DataFrame:
    return df.select(*names_except(df, excluded))


def reindex(df: DataFrame, names: list[str]) -> DataFrame:
    """Exactly these columns in this order; an absent one is NULL."""
    present = set(df.columns)
    return df.select(
        *[F.col(c) if c in present else F.lit(None).cast("double").alias(c) for c in names]
    )


def move_last(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*names_except(df, names), *names)


def rename_all(df: DataFrame, pattern: str, start: int = 0) -> DataFrame:
    """Numbered names, e.g. ``rename_all(df, 'c{i}', 4)`` -> c4, c5, ..."""
    return df.toDF(*[pattern.format(i=i) for i in range(start, start + len(df.columns))])


def narrow(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Halve the storage of the features: double -> float, but for ``keep``.

    Integers stay as they are: a value that does not fit a narrower type would be
    lost, and parquet writes small ones in few bits anyway.  -0.0 is stored as
    0.0: the two compare equal, so the least of a group could be either, by order
    of arrival.
    """
    kept = set(keep)
    # by type name; text, because feature tables have hundreds of columns
    casts = {"double": "CAST(`{0}` AS FLOAT) + 0F AS `{0}`"}
    return df.selectExpr(
        *[
            f"`{name}`" if name in kept else casts.get(dtype, "`{0}`").format(name)
            for name, dtype in df.dtypes
        ]
    )


def cast_columns(df: DataFrame, names: Iterable[str], dtype: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(dtype) for c in names})


def fill_null(df: DataFrame, value=0, names: list[str] | None = None) -> DataFrame:
    return df.fillna(value, subset=names)


def keep_one(df: DataFrame, duplicates: list[str], name: str) -> DataFrame:
    """Keep the first of several equal columns under a new name."""
    return df.withColumn(name, F.col(duplicates[0])).drop(*duplicates)


def stack_splits(train: DataFrame, test: DataFrame) -> DataFrame:
    """Union by name with the origin in ``split``; an absent column is NULL."""
    return train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test")), allowMissingColumns=True
    )


def rows_of(df: DataFrame, split: str) -> DataFrame:
    """The rows of one origin again, without the marker."""
    return df.filter(F.col("split") == split).drop("split")


def stack_targets(train: DataFrame, test: DataFrame, names: list[str]) -> DataFrame:
    """Union for a drift check: target 0 for train rows, 1 for test rows."""
    return (
        train.select(*names)
        .withColumn("target", F.lit(0))
        .unionByName(test.select(*names).withColumn("target", F.lit(1)))
    )
