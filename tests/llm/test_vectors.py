"""Hard negatives and whitening against plain computations over all rows."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tierframe.llm import hard_negatives as hn
from tierframe.llm import queries, whitening

NAN, INF = float("nan"), float("inf")


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


# --- hard negatives


def plain_negatives(rows, anchor, top_p=5, top_n=10):
    rows = [r for r in rows if r[0] is not None and r[2] is not None and r[1] is not None]
    rows = [r for r in rows if all(c is not None and math.isfinite(c) for c in r[1])]
    whole = [(i, [math.floor(256 * float(np.float32(c))) for c in v], lab) for i, v, lab in rows]
    out = set()
    for i, v, lab in whole:
        if not anchor(i):
            continue
        scored = [(-sum(map(int.__mul__, v, w)), j, other == lab) for j, w, other in whole if j != i]
        scored.sort()
        for s, p, _ in [x for x in scored if x[2]][:top_p]:
            some = [x for x in scored if not x[2] and -30 * s <= -100 * x[0] <= -90 * s]
            out |= {(i, p, n, x[1], -s, -x[0]) for n, x in enumerate(some[:top_n], 1)}
    return out


def mined(df, **named):
    rows = hn.mine(df, F.col("vec_id") % 3 == 0, **named).collect()
    assert len(rows) == len(set(map(tuple, rows)))
    return set(map(tuple, rows))


def test_negatives_of_rows_with_gaps_ties_and_copies(spark, monkeypatch):
    monkeypatch.setattr(hn, "CHUNK", 40)
    monkeypatch.setattr(hn, "BLOCK", 16)
    draw = np.random.default_rng(4)
    centres = draw.normal(0, 1, (4, 12))
    rows = [(n, (centres[n % 4] + draw.normal(0, 0.8, 12)).tolist(), int(n * 7 % 5)) for n in range(150)]
    # ties: many copies of one vector, labels of their own
    rows += [(n, rows[3][1], n % 3) for n in range(150, 210)]
    rows += [(300, None, 1), (303, [0.5] * 12, None), (306, [NAN] + [0.5] * 11, 1), (309, [INF] * 12, 1)]
    rows += [(312, [None] + [0.5] * 11, 1), (None, [0.5] * 12, 1), (315, [0.5] * 7, 1), (318, [], 2)]
    expected = plain_negatives([r for r in rows if r[1] is None or len(r[1]) == 12], lambda i: i % 3 == 0)
    df = vectors_of(spark, rows).withColumn("anchor", F.lit("x")).withColumn("means", F.lit(1))
    assert len(expected) > 500
    assert mined(df) == expected


def test_every_level_keeps_what_plain_search_finds(spark, monkeypatch):
    # picking pairs, however many, and pairs that the wide segments decide
    monkeypatch.setattr(hn, "DENSE", 2.0)
    monkeypatch.setattr(hn, "PAIRS", 300)
    draw = random.Random(1)
    rows = [(n, [draw.choice([0.1, 2.0, -1.0])] * 5 + [draw.random() for _ in range(4)], n % 4) for n in range(90)]
    assert mined(vectors_of(spark, rows)) == plain_negatives(rows, lambda i: i % 3 == 0)


def test_no_negatives(spark):
    empty = vectors_of(spark, [])
    assert mined(empty) == set() and hn.mine(empty, F.lit(True)).columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    ]
    # one label only; scores below 0; an anchor without others of its label
    assert mined(vectors_of(spark, [(0, [1.0], 1), (1, [1.0], 1)])) == set()
    assert mined(vectors_of(spark, [(0, [1.0], 1), (1, [-1.0], 1), (2, [-0.5], 2)])) == set()
    assert mined(vectors_of(spark, [(0, [1.0], 1), (1, [1.0], 2)])) == set()
    # vectors without components score 0, which is within 30 to 90 percent of 0
    assert mined(vectors_of(spark, [(0, [], 1), (1, [], 1), (2, [], 2)])) == {(0, 1, 1, 2, 0, 0)}


def test_rows_that_share_an_id(spark):
    rows = [(0, [1.0, 1.0], 1), (0, [1.0, 1.0], 1), (1, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, [0.5, 0.5], 2)]
    found = hn.mine(vectors_of(spark, rows), F.col("vec_id") == 0).collect()
    assert [tuple(r) for r in found] == [(0, 1, 1, 2, 98304, 65536)] * 2


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(0, 2**32 - 1), st.sampled_from([1, 30, 4000]))
def test_bounds_hold(dims, seed, size):
    draw = np.random.default_rng(seed)
    x = draw.integers(-size, size + 1, (20, dims))
    table = lambda v: {"v": v, "s": hn.summaries(v)}
    a, b = table(x[:10]), table(x[10:])
    at = 0
    for level in hn.LEVELS:
        n = len(hn.edges(dims, level)) - 1
        mean = a["s"][0][:, at : at + n] @ b["s"][0][:, at : at + n].T
        off = a["s"][1][:, at : at + n] @ b["s"][1][:, at : at + n].T
        low, high = hn._around(mean, off)
        exact = a["v"] @ b["v"].T
        assert (low <= exact).all() and (exact <= high).all()
        at += n


# --- whitening


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 200), st.integers(1, 6), st.integers(0, 62), st.integers(0, 2**32 - 1))
def test_cross_products_are_exact(rows, dims, bits, seed):
    draw = np.random.default_rng(seed)
    x = draw.integers(-(2**bits) + 1, 2**bits, (rows, dims))
    assert (whitening.cross_products(x) == x.astype(object).T @ x.astype(object)).all()


def check_whitened(rows, vectors, components=8):
    """Against exact sums in Python integers and an eigen-decomposition of their own."""
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(axis=0)
    off = n * x - s
    covariance = ((off.T @ off) / n**3).astype(np.float64)
    values, axes = np.linalg.eigh(covariance)
    got = {(r.vec_id, r.component): r for r in rows}
    kept = min(components, x.shape[1])
    assert len(got) == len(rows) == n * kept
    for k in range(1, kept + 1):
        column = np.array([got[i, k].whitened for i in range(n)])
        expected = (off / n).astype(np.float64) @ axes[:, -k] / math.sqrt(values[-k])
        assert min(np.abs(column - expected).max(), np.abs(column + expected).max()) < 1e-8
    for (i, k), r in got.items():
        assert r.n == n and r.deviation == sum(int(d) ** 2 for d in off[i])
        assert r.explained == pytest.approx(values[-k] / np.trace(covariance), rel=1e-9)
        assert r.identity_error < 1e-9


def test_whitening_of_the_table(spark, sf_dir):
    rows = queries.op13_whitening(spark, sf_dir).collect()
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    assert [r.vec_id for r in table] == list(range(len(table)))
    check_whitened(rows, [r.embedding for r in table])


def test_rows_that_take_no_part(spark):
    draw = np.random.default_rng(1)
    good = np.float32(draw.normal(0, 1, (40, 3)) * [3, 1, 0.2] + [0, -300, 50])
    rows = [(n, v.tolist(), None) for n, v in enumerate(good)]
    bad = [None, [None, 1.0, 1.0], [NAN, 1.0, 1.0], [1.0, -INF, 1.0], [1e38, 0.0, 0.0], [1.0], []]
    df = vectors_of(spark, rows + [(100 + n, v, 1) for n, v in enumerate(bad)])
    df = df.withColumn("vector", F.lit("x")).withColumn("whitened", F.lit(1))
    check_whitened(whitening.whiten(df).collect(), good)


def test_components_without_variance(spark):
    # the third dimension repeats the first; one row; equal rows; no rows
    rows = [(n, [float(n), float(n * n % 7), float(n)], 1) for n in range(9)]
    out = rows_of(whitening.whiten(vectors_of(spark, rows)), "vec_id", "component")
    assert len(out) == 27
    for _, component, n, _, whitened, explained, error in out:
        assert n == 9 and error < 1e-9
        assert (whitened is None) == (component == 3) == (explained == 0)
    for some in ([(5, [1.0, 2.0], 1)], [(None, [1.0, 2.0], 1), (None, [1.0, 2.0], 1)]):
        out = rows_of(whitening.whiten(vectors_of(spark, some)), "component")
        assert len(out) == 2 * len(some)
        assert {r[2:] for r in out} == {(len(some), 0, None, None, None)}
    for none in ([], [(1, None, 1)], [(1, [], 1)]):
        out = whitening.whiten(vectors_of(spark, none))
        assert out.count() == 0 and out.columns == [
            "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
        ]


def test_deviation_beyond_a_long(spark):
    rows = [(n, [2.0e6 * n, 1.0], 1) for n in range(6)] + [(6, [1e15, 0.0], 1)]
    out = whitening.whiten(vectors_of(spark, rows)).collect()
    assert all(r.deviation is None for r in out if r.vec_id == 6) and all(r.identity_error < 1e-6 for r in out)
