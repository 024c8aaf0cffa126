import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tierframe.operators.group_state import group_state, merge_states, stats_of
from tierframe.operators.stats import Stat, group_stats

EVERY = ("count", "max", "mean", "min", "std", "sum")
STATS = [Stat("x", "x", EVERY), Stat("n", "n", EVERY)]


def table(spark, rows):
    return spark.createDataFrame(rows, "g string, x double, n int")


def by_key(df):
    return {row["g"]: row.asDict() for row in df.collect()}


def close(a, b):
    assert a.keys() == b.keys()
    for key, row in a.items():
        for name, value in row.items():
            other = b[key][name]
            if isinstance(value, float) and other is not None:
                assert math.isclose(value, other, rel_tol=1e-9, abs_tol=1e-12), (key, name)
            else:
                assert value == other, (key, name)


@pytest.fixture(scope="module")
def parts(spark):
    random = np.random.default_rng(5)
    rows = [
        (
            None if i % 41 == 0 else f"g{int(random.integers(0, 9))}",
            None if i % 7 == 0 else float(random.normal()),
            None if i % 5 == 0 else int(random.integers(-50, 50)),
        )
        for i in range(900)
    ]
    # a group without any value, one of one row, one that only a part has
    odd = [("none", None, None), ("none", None, None), ("one", 2.5, 3), ("late", 1.0, 1), ("late", 4.0, 2)]
    rows += odd
    return [table(spark, rows[:200]), table(spark, rows[200:210]), table(spark, rows[210:])]


def test_merged_states_equal_the_whole(parts):
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    merged = merge_states([group_state(p, "g", ["x", "n"]) for p in parts], "g")
    close(by_key(stats_of(merged, "g", STATS)), by_key(group_stats(whole, "g", STATS)))


def test_merging_again_and_in_another_order(parts):
    a, b, c = (group_state(p, "g", ["x", "n"]) for p in parts)
    one = merge_states([merge_states([c, a], "g"), b], "g")
    close(by_key(stats_of(one, "g", STATS)), by_key(stats_of(merge_states([a, b, c], "g"), "g", STATS)))
    assert one.schema.simpleString() == a.schema.simpleString()


def test_large_offset_keeps_the_spread(spark):
    """Sums of squares would lose all of it."""
    near = [1e9 + v for v in (0.0, 1.0, 2.0, 3.0)]
    parts = [table(spark, [("a", v, 1) for v in half]) for half in (near[:2], near[2:])]
    merged = merge_states([group_state(p, "g", ["x"]) for p in parts], "g")
    std = stats_of(merged, "g", [Stat("x", "x", ("std",))]).first()["g_x_std"]
    assert math.isclose(std, np.std([0, 1, 2, 3], ddof=1), rel_tol=1e-12)


def test_empty_parts(spark, parts):
    empty = group_state(table(spark, []), "g", ["x", "n"])
    state = group_state(parts[0], "g", ["x", "n"])
    close(
        by_key(stats_of(merge_states([empty, state], "g"), "g", STATS)),
        by_key(stats_of(state, "g", STATS)),
    )
    assert merge_states([empty, empty], "g").count() == 0


def test_one_shuffle_for_any_number_of_states(spark, parts, tmp_path):
    paths = [str(tmp_path / f"s{i}") for i in range(3)]
    for part, path in zip(parts, paths):
        group_state(part, "g", ["x"]).write.parquet(path)
    merged = merge_states([spark.read.parquet(p) for p in paths], "g")
    assert plan_of(merged).count("Exchange hashpartitioning") == 1


def test_rows_are_combined_before_the_shuffle(spark):
    rows = spark.range(10).select((F.col("id") % 3).alias("g"), F.col("id").alias("x"))
    plan = plan_of(group_state(rows, "g", ["x"]))
    assert "partial_sum" in plan and plan.count("Exchange") == 1


def test_other_columns_are_refused(parts):
    with pytest.raises(ValueError, match="different columns"):
        merge_states([group_state(parts[0], "g", ["x"]), group_state(parts[1], "g", ["n"])], "g")
