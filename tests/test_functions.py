import math

import pytest
from pyspark.sql import functions as F

from tierframe.functions import classes as K
from tierframe.functions import scalar as S

NAN = float("nan")


def value(spark, expression, **columns):
    schema = ", ".join(f"{name} double" for name in columns)
    df = spark.createDataFrame([tuple(columns.values())], schema)
    return df.select(expression).first()[0]


@pytest.mark.parametrize(
    "x, expected", [(-2.0, 0.0), (0.0, 0.0), (3.5, 3.5), (None, None)]
)
def test_clamp_keeps_null(spark, x, expected):
    assert value(spark, S.clamp_negative(F.col("x")), x=x) == expected


def test_nan_becomes_null(spark):
    assert value(spark, S.nan_to_null(F.col("x")), x=NAN) is None
    assert value(spark, S.nan_to_null(F.col("x")), x=1.0) == 1.0


@pytest.mark.parametrize(
    "x, y, expected",
    [
        (1.0, 1.0, 45.0),
        (-1.0, 1.0, -45.0),
        (1.0, 0.0, 0.0),
        (0.0, 2.0, 0.0),
        (None, 0.0, 0.0),
        (None, 1.0, None),
        (1.0, None, None),
    ],
)
def test_angle(spark, x, y, expected):
    found = value(spark, S.angle(F.col("x"), F.col("y")), x=x, y=y)
    assert found == (expected if expected is None else pytest.approx(expected))


@pytest.mark.parametrize(
    "e, m, expected",
    [(8.0, 4.0, 2.0), (8.0, 0.0, 0.0), (8.0, -1.0, 0.0), (-8.0, 4.0, None), (None, 4.0, None),
     (8.0, None, 0.0)],
)
def test_speed(spark, e, m, expected):
    assert value(spark, S.speed(F.col("e"), F.col("m")), e=e, m=m) == expected


@pytest.mark.parametrize(
    "d, v, expected", [(-6.0, 2.0, 3.0), (6.0, 0.0, 0.0), (6.0, -2.0, 0.0), (6.0, None, 0.0)]
)
def test_travel_time(spark, d, v, expected):
    assert value(spark, S.travel_time(F.col("d"), F.col("v")), d=d, v=v) == expected


def test_ratio_of_zero_is_null(spark):
    assert value(spark, S.ratio(F.col("x"), F.col("y")), x=1.0, y=0.0) is None


def test_norm(spark):
    assert value(spark, S.norm(F.col("x"), F.col("y"), F.col("z")), x=2.0, y=3.0, z=6.0) == 7.0
    assert value(spark, S.norm(F.col("x"), F.col("y")), x=3.0, y=None) is None


def test_label_map_is_partial_and_invertible(spark):
    df = spark.createDataFrame([(21,), (1,), (4,), (5,), (7,), (None,)], "label int")
    mapped = df.select(K.label_to_class(F.col("label")).alias("c"))
    assert [r.c for r in mapped.collect()] == [0, 1, 2, 3, None, None]
    back = mapped.select(K.class_to_label(F.col("c")).alias("l"))
    assert [r.l for r in back.collect()] == [21, 1, 4, 5, None, None]


def test_argmax_takes_first_maximum(spark):
    df = spark.createDataFrame([([0.1, 0.4, 0.4, 0.1],), ([0.5, 0.2, 0.2, 0.5],)], "p array<double>")
    parts = [F.col("p")[k] for k in range(4)]
    found = df.select(K.argmax(F.col("p")).alias("a"), K.argmax_of(parts).alias("b")).collect()
    assert [(r.a, r.b) for r in found] == [(1, 1), (0, 0)]


def test_one_hot_outside_range_is_all_zero(spark):
    df = spark.createDataFrame([(2,), (9,), (None,)], "c int")
    found = df.select(*[f.alias(f"k{i}") for i, f in enumerate(K.one_hot(F.col("c")))]).collect()
    assert [tuple(r) for r in found] == [(0, 0, 1, 0), (0, 0, 0, 0), (0, 0, 0, 0)]


def test_percent_of_total(spark):
    assert value(spark, K.percent_of_total(F.col("x"), F.col("t")), x=1.0, t=8.0) == 12.5
    assert math.isclose(
        value(spark, K.weighted_sum([0.25, 0.75], [F.col("x"), F.col("t")]), x=1.0, t=8.0), 6.25
    )
