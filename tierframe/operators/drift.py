"""Train against test, feature by feature."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierframe.operators.profile import melt


def histogram(df: DataFrame, columns: list[str], bins: int = 20) -> DataFrame:
    """(column_name, bin, train_n, test_n) over edges both sides share.

    ``df`` has a ``split`` column.  Rows fan out to one per column inside the
    task and are counted there: the shuffle carries columns x bins rows.
    """
    long = melt(df, columns, keep=["split"]).filter(F.col("value").isNotNull())
    # one row per column
    edges = long.groupBy("column_name").agg(
        F.min("value").alias("low"), F.max("value").alias("high")
    )
    position = F.try_divide(F.col("value") - F.col("low"), F.col("high") - F.col("low"))
    bin_of = F.least(F.floor(F.coalesce(position, F.lit(0.0)) * bins), F.lit(bins - 1))
    return (
        long.join(F.broadcast(edges), "column_name")
        .groupBy("column_name", bin_of.cast("int").alias("bin"))
        .agg(
            F.count_if(F.col("split") == "train").alias("train_n"),
            F.count_if(F.col("split") == "test").alias("test_n"),
        )
    )


def drift(histograms: DataFrame, bins: int = 20) -> DataFrame:
    """(column_name, psi, ks) from the histograms.

    PSI adds half a row to every bin so that an empty one stays finite; KS is
    the largest gap of the cumulated shares at the bin edges.
    """
    whole = Window.partitionBy("column_name")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)

    def share(name):
        return (F.col(name) + 0.5) / (F.sum(name).over(whole) + 0.5 * bins)

    shares = histograms.select(
        "column_name",
        share("train_n").alias("p"),
        share("test_n").alias("q"),
        F.abs(
            F.try_divide(F.sum("train_n").over(upto), F.sum("train_n").over(whole))
            - F.try_divide(F.sum("test_n").over(upto), F.sum("test_n").over(whole))
        ).alias("gap"),
        F.count(F.lit(1)).over(whole).alias("seen"),
        F.sum("train_n").over(whole).alias("train_total"),
        F.sum("test_n").over(whole).alias("test_total"),
    )
    term = (F.col("p") - F.col("q")) * F.log(F.col("p") / F.col("q"))
    # bins that hold no row at all are absent from the input
    empty_p = F.lit(0.5) / (F.max("train_total") + 0.5 * bins)
    empty_q = F.lit(0.5) / (F.max("test_total") + 0.5 * bins)
    unseen = (bins - F.max("seen")) * (empty_p - empty_q) * F.log(empty_p / empty_q)
    return shares.groupBy("column_name").agg(
        (F.sum(term) + unseen).alias("psi"), F.max("gap").alias("ks")
    )
