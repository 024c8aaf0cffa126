"""Mix sources to target weights, with repeated epochs where a source is short.

Every document gets a hash-random key.  Inside a source the keys are cut into
ranges; the totals of the ranges give each range its offset, and a window
inside the range does the rest, so a source of any size is spread over as many
tasks as it has ranges.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierframe.llm.text import n_words
from tierframe.sources.staging import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """Words to take from each source; ``sizes`` has (source, source_size).

    The sources, by code point and null last, weigh ``weights`` in turn and
    share ``share`` times all words.  A target stops at ``cap`` times its
    source; what is above is shared again by weight until none is above.  That
    ends at one level: target = min(limit, level * weight).  With the sources in
    order of limit / weight, the level is the largest of (words left) / (weight
    left) over them.  One row per source passes through one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    tight = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    every = Window.partitionBy(F.lit(1))
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    limited = (
        sizes.withColumn("_weight", weight)
        .withColumn("_limit", F.lit(cap) * F.col("source_size"))
        .withColumn("_ratio", F.col("_limit") / F.col("_weight"))
    )
    before = tight.rowsBetween(Window.unboundedPreceding, -1)
    rest = tight.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.lit(share) * F.sum("source_size").over(every) - F.coalesce(
        F.sum("_limit").over(before), F.lit(0.0)
    )
    return (
        limited.withColumn("_level", left / F.sum("_weight").over(rest))
        .withColumn("_level", F.max("_level").over(every))
        .select(
            "source",
            "source_size",
            F.least("_limit", F.col("_level") * F.col("_weight")).alias("target"),
        )
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
) -> DataFrame:
    """How often the mix takes each document.

    Returns one row per row of ``docs``: doc_id, source, size (words, null text:
    0), source_size, target (words, of its source), copies and taken (words,
    copies * size).  A source gives whole epochs while its target allows, then
    the documents in key order whose middle lies inside what is left, so it
    ends within half a document of its target.  The key is an md5 of id and
    text: reruns agree, and rows that tie are alike in both.  A null source is a
    source, a null id an ordinary value; an empty table gives no rows.
    """
    return _mixed(docs, id_col, text_col, source_col, weights, share, cap, False)


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
) -> DataFrame:
    """The rows of the mix, each as often as it is taken, columns unchanged.

    The documents travel once, to their range; see ``mix`` for the rules.
    """
    rows = _mixed(docs, id_col, text_col, source_col, weights, share, cap, True)
    return (
        rows.filter("copies > 0")
        .select("_row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_epoch"))
        .select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
    )


def _mixed(docs, id_col, text_col, source_col, weights, share, cap, whole: bool) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        n_words(F.col(text_col)).alias("size"),
        F.md5(
            F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), text)
        ).alias("_key"),
        *([F.struct(*docs.columns).alias("_row")] if whole else []),
    )
    if not whole:
        rows = materialize(rows, "mix-sizes")
    # ranges grow with the square root of the rows: neither their number nor
    # the rows of one get out of hand
    ranges = math.isqrt(docs.count()) + 1
    place = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long")
    # the null source as a value of its own, so that joins and windows see it
    cell = ["_none", "_source", "_range"]
    rows = rows.select(
        "*",
        F.col("source").isNull().alias("_none"),
        F.coalesce("source", F.lit("")).alias("_source"),
        F.floor(place * F.lit(ranges) / F.lit(float(2**32))).cast("long").alias("_range"),
    )
    cells = rows.groupBy("source", *cell).agg(F.sum("size").alias("_sum"))
    targets = source_targets(
        cells.groupBy("source").agg(F.sum("_sum").alias("source_size")), weights, share, cap
    ).select(
        F.col("source").isNull().alias("_none"),
        F.coalesce("source", F.lit("")).alias("_source"),
        "source_size",
        "target",
    )
    up_to_here = Window.unboundedPreceding, -1
    earlier = Window.partitionBy("_none", "_source").orderBy("_range").rowsBetween(*up_to_here)
    offsets = (
        cells.drop("source")
        .withColumn("_offset", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
        .join(targets, ["_none", "_source"])
        .drop("_sum")
    )
    ahead = Window.partitionBy(*cell).orderBy("_key", "size").rowsBetween(*up_to_here)
    size, whole_source, target = F.col("size"), F.col("source_size"), F.col("target")
    epochs = F.when(whole_source > 0, F.floor(target / whole_source)).otherwise(1).cast("long")
    rest = target - F.col("_epochs") * whole_source
    inside = (rest > 0) & (F.col("_offset") + F.col("_ahead") + size / 2 <= rest)
    return (
        rows.withColumn("_ahead", F.coalesce(F.sum("size").over(ahead), F.lit(0)))
        .join(offsets, cell)
        .withColumn("_epochs", epochs)
        .withColumn("copies", F.col("_epochs") + inside.cast("long"))
        .withColumn("taken", F.col("copies") * size)
        .drop("_key", "_ahead", "_offset", "_epochs", *cell)
    )
