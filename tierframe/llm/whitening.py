"""Whitening of embeddings from exact integer cross-products, by bit slices.

Entries become integers; each dimension's bits are packed across rows into words,
so that a cross-product of two dimensions is a weighted sum of the set bits that
their planes have in common.  All sums are exact; only the eigenvectors are not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tierframe.sources.staging import materialize

SCALE, SHIFT = 1024, 100_000
# rows whose planes are multiplied at once: 64 words of each plane
SLICE = 4096
# exact sums travel as signed parts of so many bits, which Spark adds up as longs
PART_BITS = 30


def whole_entries(vector: Column) -> Column:
    """Neither null nor with null or non-finite entries, nor such whose x passes 62 bits."""
    most = float(2**62 // SCALE)
    entry = lambda c: F.coalesce(F.abs(c.cast("double")) < most, F.lit(False))
    return F.coalesce(F.forall(vector, entry), F.lit(False))


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    """x = floor(1024 c) + 100,000 of each entry; a row for each vector."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat * SCALE).astype(np.int64).reshape(len(column), dims) + SHIFT


def bit_planes(values: np.ndarray) -> np.ndarray:
    """(dimension, bit, word): the bits of non-negative values, packed across rows."""
    width = max(1, int(values.max(initial=0)).bit_length())
    rows = -(-len(values) // 64) * 64
    bits = np.zeros((values.shape[1], width, rows), np.uint8)
    for b in range(width):
        bits[:, b, : len(values)] = ((values >> b) & 1).T
    return np.packbits(bits, axis=2, bitorder="little").view(np.uint64)


def cross_products(values: np.ndarray) -> np.ndarray:
    """Sum of the products of all pairs of columns (Python integers, exact).

    Each column is shifted to start at 0, which keeps its planes few, and the shift
    is worked back in.
    """
    least = values.min(axis=0)
    shifted = values.astype(np.uint64) - least.astype(np.uint64)
    planes = bit_planes(shifted)
    dims, width, words = planes.shape
    flat = planes.reshape(dims * width, words)
    common = np.empty((dims * width, dims * width), np.int64)
    for n, plane in enumerate(flat):
        common[n, n:] = np.bitwise_count(flat[n:] & plane).sum(axis=1, dtype=np.int64)
        common[n:, n] = common[n, n:]
    common = common.reshape(dims, width, dims, width)
    # the weighted counts stay within 62 bits, or are added up as Python integers
    kind = np.int64 if 2 * width + len(values).bit_length() < 62 else object
    products = np.zeros((dims, dims), kind)
    for a in range(width):
        for b in range(width):
            products += common[:, a, :, b].astype(kind) * (1 << (a + b))
    low = least.astype(object)
    totals = shifted.astype(kind).sum(axis=0).astype(object)
    return (
        products.astype(object)
        + np.outer(low, totals)
        + np.outer(totals, low)
        + len(values) * np.outer(low, low)
    )


def _parts(value: int) -> list[int]:
    """Signed parts of PART_BITS bits, lowest first."""
    sign, value, out = (-1 if value < 0 else 1), abs(value), []
    while value:
        out.append(sign * (value & ((1 << PART_BITS) - 1)))
        value >>= PART_BITS
    return out or [0]


def fit(vectors: DataFrame, vector_col: str, components: int = 8) -> dict | None:
    """Mean, variance and leading components of the x-vectors of whole vectors.

    The driver gets a row for each pair of dimensions, which the rows of the table do
    not add to.  Returns None where no vector has an entry, else n, sums (Python
    integers), variances (all eigenvalues, falling), vectors (one column each) for up
    to ``components`` components, each with its largest entry positive.
    """
    rows = _whole(vectors, vector_col).select(F.col(vector_col).alias("vector"))
    dims = _dims(rows)
    if not dims:
        return None

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                x = _matrix(batch.column("vector").slice(start, SLICE), dims)
                n += len(x)
                sums += x.astype(object).sum(axis=0)
                products += cross_products(x)
        if n:
            upper = [(i, j, products[i, j]) for i in range(dims) for j in range(i, dims)]
            found = [(-1, -1, n), *((-1, i, s) for i, s in enumerate(sums)), *upper]
            out = [(i, j, k, p) for i, j, v in found for k, p in enumerate(_parts(int(v)))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*out)], ["i", "j", "part", "value"]
            )

    whole = rows.filter(F.size("vector") == dims)
    parts = whole.mapInArrow(scatter, "i long, j long, part long, value long")
    totals: dict[tuple[int, int], int] = {}
    for r in parts.groupBy("i", "j", "part").agg(F.sum("value").alias("value")).collect():
        totals[r.i, r.j] = totals.get((r.i, r.j), 0) + (r.value << (PART_BITS * r.part))
    n = totals[-1, -1]
    sums = [totals[-1, i] for i in range(dims)]
    covariance = np.empty((dims, dims))
    for i in range(dims):
        for j in range(i, dims):
            # centred as integers; the division rounds once
            covariance[i, j] = covariance[j, i] = (n * totals[i, j] - sums[i] * sums[j]) / (n * n)
    variances, axes = np.linalg.eigh(covariance)
    variances, axes = variances[::-1], axes[:, ::-1]
    # what rounding leaves of a direction without variance counts as 0
    variances = np.where(variances > dims * np.finfo(float).eps * variances[0], variances, 0.0)
    axes = axes[:, :components]
    largest = np.abs(axes).argmax(axis=0)
    axes = axes * np.where(axes[largest, range(axes.shape[1])] < 0, -1.0, 1.0)
    trace = float(np.trace(covariance))
    return {"n": n, "sums": sums, "variances": variances, "trace": trace, "vectors": axes}


def _whole(vectors: DataFrame, vector_col: str) -> DataFrame:
    return vectors.filter(whole_entries(F.col(vector_col)))


def _dims(rows: DataFrame) -> int:
    """Most frequent length, the larger one of two; 0 for an empty table."""
    sizes = rows.groupBy(F.size("vector").alias("size")).count()
    first: Row | None = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return first["size"] if first else 0


def _projected(vectors: DataFrame, vector_col: str, id_col: str, model: dict) -> DataFrame:
    """vec_id, deviation and the list of whitened values; null for components without variance."""
    n, sums = model["n"], np.array(model["sums"], object)
    dims, axes = model["vectors"].shape[0], model["vectors"]
    scales = np.sqrt(model["variances"][: axes.shape[1]])
    rows = _whole(vectors, vector_col).select(
        F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector")
    )

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector"), dims)
            most = int(np.abs(x).max(initial=0)) * n + max(map(abs, model["sums"]))
            kind = np.int64 if most < 2**62 else object
            off = n * x.astype(kind) - sums.astype(kind)
            largest = int(np.abs(off).max(initial=0)) if off.size else 0
            exact = off if dims * largest * largest < 2**63 else off.astype(object)
            deviation = [d if d < 2**63 else None for d in (exact * exact).sum(axis=1).tolist()]
            centred = np.asarray(off / n, np.float64)
            whitened = np.full((len(x), axes.shape[1]), np.nan)
            np.divide(centred @ axes, scales, out=whitened, where=scales > 0)
            values = pa.array(whitened.ravel(), from_pandas=True)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * axes.shape[1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    pa.array(deviation, pa.int64()),
                    pa.ListArray.from_arrays(offsets, values),
                ],
                ["vec_id", "deviation", "whitened"],
            )

    kind = rows.schema["vec_id"].dataType.simpleString()
    whole = rows.filter(F.size("vector") == dims)
    return whole.mapInArrow(project, f"vec_id {kind}, deviation long, whitened array<double>")


def whiten(
    vectors: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id", components: int = 8
) -> DataFrame:
    """Whitened leading components of all whole vectors.

    Returns for each row and component (from 1, by falling variance): vec_id,
    component, n (rows of the fit), deviation (sum over dimensions of (n x - S)^2,
    exact; null where no long holds it, which takes some million rows), whitened,
    explained (share of the variance) and identity_error (how far the covariance of
    the whitened columns, as measured over all rows, is from the identity at most).

    Rows take no part whose vector is null, holds null or non-finite entries or such
    whose x is beyond 62 bits, or is not of the most frequent length (of two the
    larger: a shorter one lacks entries).  Repeated rows and ids are rows of their
    own; a null id stays null.  A component without variance (one row, equal rows,
    dependent dimensions) has null for whitened; explained is null where nothing
    varies, identity_error where no component does.  Empty tables and vectors
    without entries give no rows.  Other columns are ignored, whatever their names.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    model = fit(vectors, vector_col, components)
    if model is None:
        return vectors.sparkSession.createDataFrame(
            [],
            f"vec_id {kind}, component int, n long, deviation long, whitened double,"
            " explained double, identity_error double",
        )
    rows = materialize(_projected(vectors, vector_col, id_col, model), "whitened")
    variances = model["variances"][: model["vectors"].shape[1]]
    varied = [k for k in range(len(variances)) if variances[k] > 0]
    error = None
    if varied:
        value = {k: F.col("whitened")[k] for k in varied}
        pairs = [(a, b) for a in varied for b in varied if a <= b]
        measured = rows.agg(
            *(F.covar_pop(value[a], value[b]).alias(f"c{n}") for n, (a, b) in enumerate(pairs))
        ).first()
        error = max(abs(measured[n] - (a == b)) for n, (a, b) in enumerate(pairs))
    shares = [float(v) / model["trace"] if model["trace"] > 0 else None for v in variances]
    share = F.array(*(F.lit(s).cast("double") for s in shares))
    return rows.select(
        "vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")
    ).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model["n"]).cast("long").alias("n"),
        "deviation",
        "whitened",
        share[F.col("place")].alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
