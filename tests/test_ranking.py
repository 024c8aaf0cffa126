"""Distributed ranks and quantiles, folds, metrics."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import plan_of, rows_of
from tierframe.operators import folds as FD
from tierframe.operators import metrics as M
from tierframe.operators.profile import describe, importance_report, quantiles, table_profile
from tierframe.operators.ranking import hash_rank, running_totals

FEW = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def test_running_totals(spark):
    source = random.Random(1)
    rows = [(g, float(x), source.randint(0, 5)) for g in "ab" for x in source.sample(range(500), 200)]
    df = spark.createDataFrame(rows, "g string, x double, n long")
    found = rows_of(running_totals(df, "g", "x", {"n": "before"}), "g", "x")
    for g in "ab":
        total = 0
        for _, _, n, before in [r for r in found if r[0] == g]:
            assert before == total
            total += n
    assert len(found) == len(rows)


def test_hash_rank_is_a_permutation_per_group(spark):
    df = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g")
    )
    found = hash_rank(df, "g", "id", "r").collect()
    assert len(found) == 3000
    for g in (None, 1, 2):
        assert sorted(r.r for r in found if r.g == g) == list(range(1000))
    in_order = [r.id for r in sorted(found, key=lambda r: r.r) if r.g == 1]
    assert in_order != sorted(in_order)


def test_no_window_gathers_everything_in_one_task(spark):
    df = spark.range(100).select("id", (F.col("id") % 2).alias("g"))
    assert "SinglePartition" not in plan_of(hash_rank(df, "g", "id", "r"))


@pytest.fixture(scope="module")
def jets(spark):
    source = random.Random(3)
    events = [e for e in range(80) for _ in range(source.choice([1, 2, 2, 3, 9]))]
    rows = [(i, e, e % 4 if e % 5 else None) for i, e in enumerate(events)]
    return spark.createDataFrame(rows, "id int, event int, label int").cache()


@pytest.mark.parametrize("assign", [FD.group_folds, FD.balanced_group_folds])
def test_a_group_never_spans_folds(jets, assign):
    folded = assign(jets, "event", 5).collect()
    assert len(folded) == jets.count()
    assert len({(r.event, r.fold) for r in folded}) == 80
    assert {r.fold for r in folded} == set(range(5))


def test_balanced_folds_differ_by_one_group_per_size(jets):
    folded = FD.balanced_group_folds(jets, "event", 5).collect()
    sizes = Counter(r.event for r in folded)
    fold_of = {r.event: r.fold for r in folded}
    for size in set(sizes.values()):
        dealt = Counter(fold_of[e] for e in sizes if sizes[e] == size)
        counts = [dealt[f] for f in range(5)]
        assert max(counts) - min(counts) <= 1


def test_balanced_folds_keep_rows_without_a_group(spark):
    df = spark.createDataFrame([(1, 7), (2, None), (3, None), (4, 8)], "id int, event int")
    folds = {r.id: r.fold for r in FD.balanced_group_folds(df, "event", 5).collect()}
    assert set(folds) == {1, 2, 3, 4} and folds[2] == folds[3] == 0


def test_ranks_shuffle_the_rows_once(spark):
    df = spark.range(0, 1000, 1, 8).select("id", (F.col("id") % 2).alias("g"))
    held = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(held)
    spark.conf.set(held, "-1")
    try:
        plan = plan_of(hash_rank(df, "g", "id", "r"))
    finally:
        spark.conf.set(held, before)
    rows = [x for x in plan.split("\n") if "Exchange hashpartitioning(_none" in x]
    # the rows once, the counts of the ranges three times
    assert len(rows) == 4 and "RangePartitioning" not in plan


def test_stratified_folds_keep_the_label_mix(jets):
    folded = FD.stratified_folds(jets, "label", "id").collect()
    assert len(folded) == jets.count()
    for label in {r.label for r in folded}:
        counts = Counter(r.fold for r in folded if r.label == label)
        assert max(counts.values()) - min(counts[f] for f in range(5)) <= 1


def test_folds_do_not_depend_on_partitioning(spark, jets):
    moved = jets.repartition(3, "label")
    for assign in (
        lambda df: FD.balanced_group_folds(df, "event"),
        lambda df: FD.stratified_folds(df, "label", "id"),
        lambda df: FD.holdout(df, "id"),
    ):
        assert rows_of(assign(jets).drop("label"), "id") == rows_of(assign(moved).drop("label"), "id")


def test_holdout_share(spark):
    held = FD.holdout(spark.range(20000), "id", 0.33).filter("held_out").count()
    assert 0.31 < held / 20000 < 0.35


def test_training_and_validation_rows(jets):
    folded = FD.group_folds(jets, "event")
    train, valid = FD.training_rows(folded, 2), FD.validation_rows(folded, 2)
    assert train.count() + valid.count() == jets.count()
    assert train.join(valid, "event").count() == 0


def brute_auc(truth, score, k):
    pos = [s for t, s in zip(truth, score) if t == k]
    neg = [s for t, s in zip(truth, score) if t != k]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


@FEW
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3)), min_size=8, max_size=40))
def test_hard_label_auc_is_the_rank_statistic(spark, pairs):
    pairs = pairs + [(k, 0) for k in range(4)]
    df = spark.createDataFrame(pairs, "t int, p int")
    aucs = M.hard_label_aucs(F.col("t"), F.col("p"))
    row = df.agg(*aucs, M.macro_auc(F.col("t"), F.col("p"))).first()
    wanted = [
        brute_auc([t for t, _ in pairs], [float(p == k) for _, p in pairs], k) for k in range(4)
    ]
    assert list(row)[:4] == pytest.approx(wanted)
    assert row[4] == pytest.approx(sum(wanted) / 4)


def test_score_auc_against_brute_force(spark):
    source = random.Random(9)
    rows = [
        (source.randint(0, 3), *[source.randint(0, 20) / 20 for _ in range(4)]) for _ in range(120)
    ]
    df = spark.createDataFrame(rows, "t int, p0 double, p1 double, p2 double, p3 double")
    found = dict(rows_of(M.score_aucs(df, "t", ["p0", "p1", "p2", "p3"]).select("class", "auc")))
    for k in range(4):
        assert found[k] == pytest.approx(brute_auc([r[0] for r in rows], [r[k + 1] for r in rows], k))


def test_hard_labels_as_scores_give_the_same_auc(spark):
    df = spark.range(200).select(
        (F.col("id") % 4).cast("int").alias("t"), (F.col("id") * 7 % 5 % 4).cast("int").alias("p")
    )
    hard = df.agg(*M.hard_label_aucs(F.col("t"), F.col("p"))).first()
    flags = [(F.col("p") == k).cast("double").alias(f"s{k}") for k in range(4)]
    soft = M.score_aucs(df.select("t", *flags), "t", [f"s{k}" for k in range(4)])
    assert [a for _, a in rows_of(soft.select("class", "auc"))] == pytest.approx(list(hard))


def test_absent_class_has_no_auc(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (1, 0)], "t int, p int")
    row = df.agg(*M.hard_label_aucs(F.col("t"), F.col("p"))).first()
    assert row[2] is None and row[3] is None and row[1] == 0.75


def test_quantiles_interpolate_like_numpy(spark):
    source = random.Random(4)
    xs = [float(source.randint(-20, 20)) for _ in range(101)]
    ys = [source.random() if i % 9 else None for i in range(101)]
    df = spark.createDataFrame(list(zip(xs, ys)), "x double, y double")
    marks = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    found = {(r.column_name, r.probability): r.value for r in quantiles(df, ["x", "y"], marks).collect()}
    for name, values in (("x", xs), ("y", [y for y in ys if y is not None])):
        for q in marks:
            assert found[name, q] == pytest.approx(np.quantile(values, q))


def test_describe_and_profile(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, 2.0), (8.0, None)], "x double, y double")
    found = {r.column_name: r for r in describe(df, ["x", "y"]).collect()}
    assert tuple(found["x"])[1:] == pytest.approx((3, 4.0, 13**0.5, 1.0, 2.0, 3.0, 5.5, 8.0))
    assert (found["y"]["count"], found["y"]["std"], found["y"]["q50"]) == (1, None, 2.0)
    assert [(r.column_name, r.n_rows, r.n_present) for r in table_profile(df).collect()] == [
        ("x", 3, 3), ("y", 3, 1)
    ]


def test_importance_report(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 0.0), ("c", 3.0), ("d", 1.0)], "feature string, gain double")
    assert [tuple(r) for r in importance_report(df, 2).collect()] == [("c", 3.0, 60.0), ("a", 1.0, 20.0)]
