"""Own aggregates and row functions against the native ones."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tierframe.catalog import table_queries
from tierframe.operators import own
from tierframe.operators.stats import majority


@pytest.fixture(scope="module")
def rows(spark):
    data = [(None if n % 31 == 0 else n % 13 if n % 3 else 7, n * n % 5 if n % 11 else None, n / 7) for n in range(900)]
    return spark.createDataFrame(data, "id long, label int, x double").repartition(7)


def test_vote_equals_the_native_one(rows):
    got = table_queries.OWN_VOTE.per_group(rows, "id", ["label"], "label")
    assert rows_of(got) == rows_of(majority(rows.filter("id IS NOT NULL"), "id", "label"))


def test_deviation_equals_the_native_one(rows):
    got = {r.id: r.s for r in table_queries.OWN_DEVIATION.per_group(rows, "id", ["x"], "s").collect()}
    want = {r.id: r.s for r in rows.filter("id IS NOT NULL").groupBy("id").agg(F.stddev_samp("x").alias("s")).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_states_sent_early_give_the_same(rows, monkeypatch):
    want = rows_of(table_queries.OWN_VOTE.per_group(rows, "id", ["label"], "label"))
    monkeypatch.setattr(own, "HELD", 2)
    # small batches, so that states of a key are sent more than once
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "9")
    try:
        assert rows_of(table_queries.OWN_VOTE.per_group(rows, "id", ["label"], "label")) == want
    finally:
        rows.sparkSession.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_rows_of_a_key_are_added_together(spark):
    calls = own.OwnAggregate(lambda: 0, lambda n, frame: n + 1, lambda a, b: a + b, lambda n: n, "int")
    spread = spark.range(6000, numPartitions=6).select((F.col("id") % 200).alias("k"), "id")
    got = calls.per_group(spread, "k", ["id"], "n").collect()
    # one frame for each key, and a second one where a batch ends inside of it
    assert len(got) == 200 and sum(r.n for r in got) <= 210


def test_text_keys_no_rows_and_fractional_keys(rows):
    letters = own.OwnAggregate(
        Counter, lambda s, f: s + Counter("".join(f["t"].dropna())), lambda a, b: a + b,
        lambda s: sorted(s), "array<string>",
    )
    df = rows.sparkSession.createDataFrame([("a", "xy"), ("a", "yz"), ("é", None)], "k string, t string")
    assert rows_of(letters.per_group(df, "k", ["t"], "v")) == [("a", ["x", "y", "z"]), ("é", [])]
    assert letters.per_group(df.limit(0), "k", ["t"], "v").collect() == []
    with pytest.raises(ValueError, match="fractional"):
        letters.per_group(rows, "x", ["label"], "v")


def test_row_function(rows):
    got = own.with_row_function(
        rows, "v", lambda r: None if r.label is None else math.hypot(r.x, r.label), ["x", "label"], "double"
    )
    assert got.columns == ["id", "label", "x", "v"]
    for r in got.collect():
        assert r.v == (None if r.label is None else math.hypot(r.x, r.label))
