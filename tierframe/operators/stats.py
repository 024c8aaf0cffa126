"""Statistics per group, alone or attached to every row of the group.

Rows are always combined before the shuffle that decides, so no task ever holds
a whole group, and the plan is the same at every size.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierframe.operators.joins import lookup_join
from tierframe.sources.staging import materialize

# Statistic -> SQL aggregate.
AGGREGATES = {
    "count": "count",
    "max": "max",
    "mean": "avg",
    "min": "min",
    "std": "stddev_samp",
    "sum": "sum",
}

# keys are hashed into cells; rows of a cell with more rows are combined before the shuffle
CELLS = 1 << 16
HOT_ROWS = 1_000_000


@dataclass(frozen=True)
class Stat:
    """Statistics of one source column, named ``<key>_<family>_<kind>``.

    ``digits`` rounds the means: the last bits of a sum of fractions depend on
    the order in which Spark adds them.
    """

    source: str
    family: str
    kinds: tuple[str, ...]
    digits: int | None = None

    def texts(self, key: str) -> list[str]:
        """SQL text of the statistics."""
        return [
            f"{self.rounded(kind, f'{AGGREGATES[kind]}({self.source})')}"
            f" AS {key}_{self.family}_{kind}"
            for kind in self.kinds
        ]

    def rounded(self, kind: str, text: str) -> str:
        return f"round({text}, {self.digits})" if kind == "mean" and self.digits else text


def with_digits(stats: list[Stat], digits: int | None) -> list[Stat]:
    return [replace(stat, digits=digits) for stat in stats]


def _unchanged(df: DataFrame) -> DataFrame:
    return df


def group_stats(
    rows: DataFrame,
    key: str,
    stats: list[Stat],
    extra: tuple[str, ...] = (),
    derive: Callable[[DataFrame], DataFrame] = _unchanged,
) -> DataFrame:
    """One row per key, combined before the shuffle.

    ``derive`` adds the source columns to the rows; ``extra`` is SQL text of
    further aggregates.  A group of any size reaches its reducer as one row
    per map task.  Right where groups are large next to the number of
    aggregates.
    """
    texts = [text for stat in stats for text in stat.texts(key)] + list(extra)
    known = rows.filter(F.col(key).isNotNull())
    return derive(known).groupBy(key).agg(*[F.expr(text) for text in texts])


def wide_group_stats(
    rows: DataFrame,
    key: str,
    stats: list[Stat],
    extra: tuple[str, ...] = (),
    derive: Callable[[DataFrame], DataFrame] = _unchanged,
) -> DataFrame:
    """The same result for many statistics of small groups.

    Hundreds of aggregates make a partial result far wider than the few rows
    it stands for.  So the raw rows are brought together by key first and
    ``derive`` runs after that.  The rebalancing may split the partition of a hot
    key, which is why the combined rows, about one per group, are shuffled once
    more to be finished.
    """
    return group_stats(rows.hint("rebalance", key), key, stats, extra, derive)


def by_small_groups(
    rows: DataFrame, key: str, plan: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``plan``, one row per key, of rows that are brought together by key first.

    Where groups are small and their rows lie apart, partial results combine little and
    are wider than the raw rows; after the rebalancing no further shuffle is needed.  Keys
    in a cell of more than HOT_ROWS rows are left to the shuffles of ``plan`` itself, so a
    hot key is combined in the map tasks.  The cells are counted first, in a pass that
    shuffles one row per cell and task; the driver gets the hot ones only.  Rows
    without a key are left out.
    """
    known = rows.filter(F.col(key).isNotNull())
    cell = F.pmod(F.xxhash64(key), F.lit(CELLS))
    sizes = known.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    hot = [r["cell"] for r in sizes.filter(F.col("n") > HOT_ROWS).select("cell").collect()]
    if not hot:
        return plan(known.hint("rebalance", key))
    small = plan(known.filter(~cell.isin(hot)).hint("rebalance", key))
    return small.unionByName(plan(known.filter(cell.isin(hot))))


def with_group_stats(rows: DataFrame, key: str, stats: list[Stat]) -> DataFrame:
    """Every row, with the statistics of its group."""
    return lookup_join(rows, group_stats(rows, key, stats), key, "left")


def with_wide_group_stats(
    rows: DataFrame,
    key: str,
    stats: list[Stat],
    extra: dict[str, str] | None = None,
    derive: Callable[[DataFrame], DataFrame] = _unchanged,
) -> DataFrame:
    """Every row, derived, with many statistics of its small group.

    The raw rows are staged, as they are read twice: for the statistics and for
    the join with them.  Rows without a key have NULL statistics.  ``extra`` maps
    further names to aggregates.
    """
    aggregates = tuple(f"{aggregate} AS {name}" for name, aggregate in (extra or {}).items())
    rows = materialize(rows, "rows")
    per_group = wide_group_stats(rows, key, stats, aggregates, derive)
    return lookup_join(derive(rows), per_group, key, "left")


def distinct_count(df: DataFrame, key: str, column: str, name: str) -> DataFrame:
    """Distinct values per key; NULL counts as one value.

    Two aggregates, so no task holds the set of values of a group.
    """
    return df.groupBy(key, column).agg(F.lit(1)).groupBy(key).agg(
        F.count(F.lit(1)).cast("int").alias(name)
    )


def signed_distinct_count(
    df: DataFrame, key: str, column: str, name: str, abs_name: str
) -> DataFrame:
    """Distinct values and distinct magnitudes per key from one grouping.

    A group per magnitude knows which of its two signs occur, so the number of
    signed values is the sum of the signs and that of magnitudes the row count.
    """
    negative = F.max((F.col(column) < 0).cast("int"))
    other = F.max((F.col(column) >= 0).cast("int"))
    per_magnitude = df.groupBy(key, F.abs(column).alias("magnitude")).agg(
        F.coalesce(negative + other, F.lit(1)).alias("signs")
    )
    return per_magnitude.groupBy(key).agg(
        F.sum("signs").cast("int").alias(name),
        F.count(F.lit(1)).cast("int").alias(abs_name),
    )


def agreement(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, n_values, agrees): distinct values of each group, NULL not counted.

    The check before one value may stand for a group: see ``require_agreement``.
    """
    return (
        df.groupBy(key, column).agg(F.lit(1)).groupBy(key)
        .agg(F.count(column).alias("n_values"))
        .withColumn("agrees", F.col("n_values") <= 1)
    )


def require_agreement(df: DataFrame, key: str, column: str) -> None:
    """An error that names some groups if any holds several values."""
    odd = agreement(df, key, column).filter("NOT agrees").select(key).limit(5).collect()
    if odd:
        raise ValueError(f"several values of {column} in {key} {[r[0] for r in odd]}")


def majority(df: DataFrame, key: str, column: str) -> DataFrame:
    """Most frequent value per key, of any ordered type; the smallest one wins a tie."""
    votes = df.filter(F.col(column).isNotNull()).groupBy(key, column).agg(
        F.count(F.lit(1)).alias("votes")
    )
    best = F.min(F.struct((-F.col("votes")).alias("fewer"), F.col(column)))
    return votes.groupBy(key).agg(best.alias("best")).select(key, f"best.{column}")


def vote(df: DataFrame, key: str, column: str) -> DataFrame:
    """Replace the value of each row by the majority of its group."""
    return lookup_join(df.drop(column), majority(df, key, column), key, "left")


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()
