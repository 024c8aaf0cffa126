"""Hard negatives of anchors, by bounds on inner products from segment summaries.

Of every vector the mean and the deviation of its segments are stored, at several
widths.  The product of two segments is the product of their means times their
length, give or take the product of their deviations; the sums of these bound a
score.  Pairs that the bounds of wide segments cannot decide go on to narrower ones,
and only what is left is scored exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tierframe.sources.staging import materialize

# segments of the summaries, from wide to narrow
LEVELS = (1, 4, 16)
# rows and anchors that meet in one task at a time, on the average
CHUNK, BLOCK = 2048, 2048
# pairs that are looked at at once: bounds the memory of a task
PAIRS = 1 << 18
# above this share of undecided pairs one matrix product is cheaper than picking them
DENSE = 0.25


def edges(dims: int, segments: int) -> np.ndarray:
    """Where the segments begin and end; never more segments than dimensions."""
    return np.unique(np.linspace(0, dims, min(segments, dims) + 1).astype(int))


def summaries(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means (times the root of the length) and deviations, level after level."""
    means, deviations = [], []
    for level in LEVELS:
        at = edges(vectors.shape[1], level)
        for start, stop in zip(at[:-1], at[1:]):
            part = vectors[:, start:stop].astype(np.float64)
            mean = part.mean(axis=1)
            means.append(mean * np.sqrt(stop - start))
            deviations.append(np.sqrt(np.square(part - mean[:, None]).sum(axis=1)))
    shape = (len(vectors), len(means))
    return np.array(means).T.reshape(shape), np.array(deviations).T.reshape(shape)


def whole_vectors(vector: Column) -> Column:
    """Neither null nor with null or non-finite components."""
    finite = lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False))
    return F.coalesce(F.forall(vector, finite), F.lit(False))


def _prepared(vectors: DataFrame, scale: int) -> DataFrame:
    """Rows that take part, as integers with their summaries, staged."""
    whole = vectors.filter("vec_id IS NOT NULL AND label IS NOT NULL").filter(whole_vectors(F.col("vector")))
    sizes = whole.groupBy(F.size("vector").alias("size")).count()
    first: Row | None = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    dims = first["size"] if first else 0
    rows = whole.filter(F.size("vector") == dims).select(
        "vec_id", "label", F.transform("vector", lambda c: F.floor(c.cast("double") * scale)).alias("vector")
    )

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector"), dims)
            parts = [_lists(m) for m in summaries(x)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *parts], [*batch.schema.names, "means", "deviations"]
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return materialize(
        rows.mapInArrow(summed, f"{kinds}, means array<double>, deviations array<double>"), "vectors"
    )


def _matrix(column, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def _lists(values: np.ndarray) -> pa.ListArray:
    offsets = pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1])
    return pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))


class Side:
    """Vectors of a chunk or block with what bounds their scores."""

    def __init__(self, table: pa.Table):
        n = table.num_rows
        self.ids = table.column("vec_id").to_numpy()
        self.labels = np.array(table.column("label").to_pylist(), object)
        widths = {c: len(table.column(c)[0]) if n else 0 for c in ("vector", "means", "deviations")}
        self.vectors, self.means, self.deviations = (
            _matrix(table.column(c), w) for c, w in widths.items()
        )
        at = [0]
        for level in LEVELS:
            at.append(at[-1] + len(edges(widths["vector"], level)) - 1)
        self.levels = list(zip(at[:-1], at[1:]))
        # sums of products of whole numbers below 2^53 are exact in floating point
        self.largest = int(np.abs(self.vectors).max(initial=0))

    def bounds(self, other: Side, mine: np.ndarray, others: np.ndarray, level: int) -> tuple:
        """Least and greatest score of the pairs (mine[k], others[k]), by the segments of a level."""
        part = slice(*self.levels[level])
        mean = np.einsum("ij,ij->i", self.means[mine, part], other.means[others, part])
        off = np.einsum("ij,ij->i", self.deviations[mine, part], other.deviations[others, part])
        return _around(mean, off)

    def scores(self, other: Side, mine: np.ndarray, others: np.ndarray) -> np.ndarray:
        if self.largest * other.largest * max(1, self.vectors.shape[1]) >= 2**63:
            raise OverflowError("inner products of these vectors do not fit a long")
        return np.einsum("ij,ij->i", self.vectors[mine], other.vectors[others])

    def all_scores(self, other: Side, mine: slice) -> np.ndarray | None:
        """All pairs by one product, or None where that would round."""
        if self.largest * other.largest * max(1, self.vectors.shape[1]) >= 2**53:
            return None
        return (self.vectors[mine].astype(np.float64) @ other.vectors.astype(np.float64).T).astype(np.int64)


def _around(mean: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    # rounding may not push a score out of its bounds
    off = off + 1e-9 * (np.abs(mean) + off) + 1e-6
    return mean - off, mean + off


def best_of(
    anchors: Side, rows: Side, same: bool, low: np.ndarray, high: np.ndarray, top: int
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(anchor, window, rows, scores): at least the ``top`` best pairs of each window.

    ``low`` and ``high`` (anchor x window) are the scores that a window takes, both
    included; ``same`` chooses rows of the anchor's label, else those of others.  A
    row is never paired with an anchor of its id.  Pairs leave as soon as their upper
    bound is below every window or below ``top`` lower bounds that are surely inside
    one, or their lower bound above every window.
    """
    step = max(1, PAIRS // max(1, len(rows.ids)))
    _, label = np.unique(np.concatenate([anchors.labels, rows.labels]), return_inverse=True)
    mine_, theirs = label[: len(anchors.ids)], label[len(anchors.ids) :]
    for start in range(0, len(anchors.ids), step):
        part = slice(start, start + step)
        alike = mine_[part, None] == theirs[None, :]
        open_ = (alike == same) & (anchors.ids[part, None] != rows.ids[None, :])
        floor, roof = low[part].copy(), high[part]
        for level in range(len(LEVELS)):
            if open_.mean() > DENSE:
                cut = slice(*rows.levels[level])
                least, most = _around(
                    anchors.means[part, cut] @ rows.means[:, cut].T,
                    anchors.deviations[part, cut] @ rows.deviations[:, cut].T,
                )
            else:
                mine, others = np.nonzero(open_)
                least, most = np.full(open_.shape, np.inf), np.full(open_.shape, -np.inf)
                least[mine, others], most[mine, others] = anchors.bounds(rows, mine + start, others, level)
            wanted = np.zeros_like(open_)
            for w in range(floor.shape[1]):
                sure = open_ & (least >= low[part, w, None]) & (most <= roof[:, w, None])
                if top <= len(rows.ids):
                    bound = np.where(sure, least, -np.inf)
                    kth = np.partition(bound, -top, axis=1)[:, -top]
                    floor[:, w] = np.maximum(floor[:, w], kth)
                wanted |= (most >= floor[:, w, None]) & (least <= roof[:, w, None])
            open_ &= wanted
        exact = anchors.all_scores(rows, part) if open_.mean() > DENSE else None
        if exact is None:
            mine, others = np.nonzero(open_)
            exact = np.zeros(open_.shape, np.int64)
            exact[mine, others] = anchors.scores(rows, mine + start, others)
        for a, w in np.ndindex(floor.shape):
            found = np.flatnonzero(open_[a] & (exact[a] >= floor[a, w]) & (exact[a] <= roof[a, w]))
            if len(found):
                order = np.lexsort((rows.ids[found], -exact[a, found]))[:top]
                yield start + a, w, found[order], exact[a, found[order]]


def _grid(rows: DataFrame, anchors: DataFrame) -> tuple[int, int]:
    """Chunks of the rows and blocks of the anchors."""
    return max(1, -(-rows.count() // CHUNK)), max(1, -(-anchors.count() // BLOCK))


def _met(
    rows: DataFrame, anchors: DataFrame, grid: tuple[int, int], found: Callable, schema: str
) -> DataFrame:
    """Every chunk of the rows meets every block of the anchors in a group of its own."""
    chunks, blocks = grid
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # a hash of all that is in a row, so that rows of one id are spread too
    place = F.xxhash64("vec_id", "label", F.monotonically_increasing_id())
    left = rows.withColumn("chunk", F.pmod(place, F.lit(chunks)).cast("int")).withColumn("block", spread(blocks))
    right = anchors.withColumn(
        "block", F.pmod(F.xxhash64("anchor"), F.lit(blocks)).cast("int")
    ).withColumn("chunk", spread(chunks))
    keys = ("block", "chunk")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(found, schema)


def _anchors(rows: DataFrame, is_anchor: Column) -> DataFrame:
    """Anchors, each once, under a key of their own."""
    chosen = rows.filter(is_anchor).dropDuplicates(["vec_id", "label", "vector"])
    return chosen.withColumn("anchor", F.xxhash64("vec_id", "label", "vector"))


def positives(rows: DataFrame, anchors: DataFrame, grid: tuple[int, int], n: int) -> DataFrame:
    """The n best rows of each anchor's label: anchor, anchor_id, positive_id, positive_score, place."""

    def found(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk, block = Side(left), Side(right)
        keys = right.column("anchor").to_numpy()
        any_ = np.full((len(block.ids), 1), np.inf)
        out = [
            (np.full(len(at), keys[a]), np.full(len(at), block.ids[a]), chunk.ids[at], scores)
            for a, _, at, scores in best_of(block, chunk, True, -any_, any_, n)
        ]
        return _table(out, ["anchor", "anchor_id", "positive_id", "positive_score"])

    pairs = _met(rows, anchors, grid, found, "anchor long, anchor_id long, positive_id long, positive_score long")
    best = Window.partitionBy("anchor_id", "anchor").orderBy(F.desc("positive_score"), "positive_id")
    return pairs.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= n)


def _table(parts: list[tuple], names: list[str]) -> pa.Table:
    columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.empty(0)] * len(names)
    return pa.table({n: pa.array(c.astype(np.int64)) for n, c in zip(names, columns)})


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    vector_col: str = "embedding",
    id_col: str = "vec_id",
    label: Column | None = None,
    scale: int = 256,
    n_positives: int = 5,
    n_negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """Hard negatives of each anchor and positive, found exactly.

    Components become floor(scale * x); scores are integer inner products.  An
    anchor's positives are its ``n_positives`` best other rows of the same label, and
    the negatives of a positive the ``n_negatives`` best rows of other labels whose
    score is from ``low`` to ``high`` percent of the positive's.  Ties go to the
    smaller id.  ``is_anchor`` is a condition on the id (column ``vec_id``).

    Returns anchor_id, positive_id, rank (int, from 1), negative_id, positive_score
    and negative_score.  A positive without negatives has no row, so one with a
    score below 0 never has.

    Rows take no part whose id, label or vector is null, whose vector holds null or
    non-finite components or is not of the most frequent length (of two the larger).
    Rows that share an id are rows of their own, but none is a positive of an anchor
    of its id; anchors alike in id, label and vector are one.  Vectors without
    components score 0.  Empty tables give no rows; other columns are ignored,
    whatever their names.  A score beyond a long is an error.
    """
    label = F.col("label") if label is None else label
    rows = _prepared(
        vectors.select(
            F.col(id_col).cast("long").alias("vec_id"), label.alias("label"), F.col(vector_col).alias("vector")
        ),
        scale,
    )
    anchors = materialize(_anchors(rows, is_anchor), "anchors")
    grid = _grid(rows, anchors)
    best = materialize(positives(rows, anchors, grid, n_positives), "positives")
    wanted = best.groupBy("anchor_id", "anchor").agg(
        F.collect_list(F.struct("place", "positive_id", "positive_score")).alias("positives")
    )
    seeking = anchors.withColumn("anchor_id", F.col("vec_id")).join(wanted, ["anchor_id", "anchor"])

    def found(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk, block = Side(left), Side(right)
        keys = right.column("anchor").to_numpy()
        wants = right.column("positives").to_pylist()
        # a window without a positive takes nothing
        floor = np.full((len(wants), n_positives), np.inf)
        roof = np.full((len(wants), n_positives), -np.inf)
        for a, some in enumerate(wants):
            for w in some:
                # 100 n >= low p and 100 n <= high p, in whole numbers
                floor[a, w["place"] - 1] = -(-low * w["positive_score"] // 100)
                roof[a, w["place"] - 1] = high * w["positive_score"] // 100
        out = [
            (
                np.full(len(at), keys[a]),
                np.full(len(at), block.ids[a]),
                np.full(len(at), w + 1),
                chunk.ids[at],
                scores,
            )
            for a, w, at, scores in best_of(block, chunk, False, floor, roof, n_negatives)
        ]
        return _table(out, ["anchor", "anchor_id", "place", "negative_id", "negative_score"])

    schema = "anchor long, anchor_id long, place long, negative_id long, negative_score long"
    pairs = _met(rows, seeking.drop("anchor_id"), grid, found, schema)
    ranked = Window.partitionBy("anchor_id", "anchor", "place").orderBy(F.desc("negative_score"), "negative_id")
    top = pairs.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= n_negatives)
    return top.join(best, ["anchor", "anchor_id", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
