"""Assignment of rows to folds and samples, by key and never by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierframe.operators.joins import lookup_join
from tierframe.operators.ranking import hash_order, hash_rank


def hash_bucket(x: Column, n: int) -> Column:
    """0..n-1 from the first 8 hex digits of the md5 of the text of ``x``."""
    digits = F.substring(F.md5(x.cast("string")), 1, 8)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(n)).cast("int")


def group_folds(df: DataFrame, group: str, n: int = 5, name: str = "fold") -> DataFrame:
    """Group k-fold without a shuffle: the fold is a hash of the group."""
    return df.withColumn(name, hash_bucket(F.col(group), n))


def balanced_group_folds(
    df: DataFrame, group: str, n: int = 5, name: str = "fold"
) -> DataFrame:
    """Group k-fold with near-equal row counts.

    The groups of each size are dealt out in hash order, forth and back
    (0..n-1, n-1..0), so two folds differ by at most one group per size.  Rows
    without a group stay together in fold 0.
    """
    folds = fold_of_group(df.filter(F.col(group).isNotNull()), group, n, name)
    return lookup_join(df, folds, group, "left").fillna(0, [name])


def fold_of_group(df: DataFrame, group: str, n: int, name: str = "fold") -> DataFrame:
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("size"))
    dealt = hash_rank(sizes, "size", group, "position", seed="fold")
    step = F.pmod(F.col("position"), F.lit(2 * n))
    fold = F.when(step < n, step).otherwise(2 * n - 1 - step)
    return dealt.select(group, fold.cast("int").alias(name))


def stratified_folds(
    df: DataFrame, label: str, key: str, n: int = 5, seed: int = 42, name: str = "fold"
) -> DataFrame:
    """k-fold with the label mix of the whole: rows of each label are dealt
    out in pseudo-random order.  ``key`` is unique."""
    ranked = hash_rank(df, label, key, "_position", seed)
    fold = F.pmod(F.col("_position"), F.lit(n)).cast("int")
    return ranked.withColumn(name, fold).drop("_position")


def holdout(
    df: DataFrame, key: str, test_share: float = 0.33, seed: int = 42, name: str = "held_out"
) -> DataFrame:
    """Random hold-out mark; depends on the key alone, so it is repeatable."""
    draw = F.conv(F.substring(hash_order(seed, key), 1, 8), 16, 10).cast("long")
    return df.withColumn(name, draw < F.lit(int(test_share * (1 << 32))))


def training_rows(df: DataFrame, fold: int, name: str = "fold") -> DataFrame:
    return df.filter(F.col(name) != fold)


def validation_rows(df: DataFrame, fold: int, name: str = "fold") -> DataFrame:
    return df.filter(F.col(name) == fold)
