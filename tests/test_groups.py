"""Group statistics, hot keys, lookup joins, votes."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, rows_of
from tierframe.catalog.feature_queries import stored
from tierframe.operators import joins as J
from tierframe.operators import stats as ST
from tierframe.plans.event_table import event_table
from tierframe.plans.jets import event_stats, jet_table
from tierframe.plans.particles import BROAD, COMPACT, jet_stats
from tierframe.sources import views as V

FIVE = ("count", "max", "mean", "min", "std", "sum")


@pytest.fixture(scope="module")
def lopsided(spark):
    """Key 0 holds a third of the rows; some keys and values are NULL."""
    source = random.Random(5)
    rows = []
    for i in range(300):
        key = 0 if i % 3 == 0 else (None if i % 50 == 1 else source.randint(1, 40))
        rows.append((i, key, None if i % 17 == 0 else float(source.randint(-9, 9))))
    return spark.createDataFrame(rows, "id int, k int, x double").cache()


def expected_stats(rows):
    groups = {}
    for r in rows:
        if r.k is not None:
            groups.setdefault(r.k, [])
            if r.x is not None:
                groups[r.k].append(r.x)
    out = {}
    for k, xs in groups.items():
        out[k] = (
            len(xs),
            max(xs) if xs else None,
            statistics.fmean(xs) if xs else None,
            min(xs) if xs else None,
            statistics.stdev(xs) if len(xs) > 1 else None,
            sum(xs) if xs else None,
        )
    return out


def check(found, rows):
    wanted = expected_stats(rows)
    for r in found:
        for kind, value in zip(FIVE, wanted[r.k]):
            got = r[f"k_x_{kind}"]
            assert got == (value if value is None else pytest.approx(value)), (r.k, kind)


def doubled(df):
    return df.withColumn("y", F.col("x") * 2)


def test_group_stats(lopsided):
    found = ST.group_stats(lopsided, "k", [ST.Stat("x", "x", FIVE)]).collect()
    check(found, lopsided.collect())
    assert len(found) == len(expected_stats(lopsided.collect()))


def test_wide_stats(lopsided):
    stats = [ST.Stat("x", "x", FIVE), ST.Stat("y", "y", ("sum",))]
    found = ST.wide_group_stats(lopsided, "k", stats, ("count(id) AS n",), doubled).collect()
    check(found, lopsided.collect())
    assert len({r.k for r in found}) == len(found)
    for r in found:
        assert r.k_y_sum == (None if r.k_x_sum is None else 2 * r.k_x_sum)


def test_attached_stats_keep_every_row(lopsided):
    stats = [ST.Stat("x", "x", FIVE)]
    wide = ST.with_wide_group_stats(lopsided, "k", stats, {"n": "count(id)"}, doubled)
    plain = ST.with_group_stats(lopsided, "k", stats)
    for df in (wide, plain):
        rows = df.collect()
        check([r for r in rows if r.k is not None], lopsided.collect())
        assert sorted(r.id for r in rows) == list(range(300))
        assert all(r.k_x_sum is None for r in rows if r.k is None)


def test_a_hot_key_is_combined_before_the_last_shuffle(lopsided):
    """Between the rows and the result stands a partial aggregate, so a group is
    never gathered in one task; the raw rows are spread by a split-able shuffle."""
    df = ST.wide_group_stats(lopsided, "k", [ST.Stat("x", "x", FIVE)], derive=doubled)
    plan = plan_of(df)
    assert "partial_sum" in plan and "REBALANCE_PARTITIONS_BY_COL" in plan
    assert "Window" not in plan


def test_single_member_has_no_std(spark):
    df = spark.createDataFrame([("a", 4.0)], "k string, x double")
    r = ST.group_stats(df, "k", [ST.Stat("x", "x", FIVE)]).first()
    assert (r.k_x_std, r.k_x_sum, r.k_x_mean) == (None, 4.0, 4.0)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join(spark, lopsided, how):
    lookup = spark.createDataFrame([(k, f"v{k}") for k in range(30)], "k int, v string")
    joined = J.lookup_join(lopsided, lookup, "k", how).select("id", "k", "v").collect()
    known = {r.id: r.k for r in lopsided.collect()}
    wanted = {i for i, k in known.items() if how == "left" or (k is not None and k < 30)}
    assert {r.id for r in joined} == wanted and len(joined) == len(wanted)
    assert all(r.v == (f"v{r.k}" if r.k is not None and r.k < 30 else None) for r in joined)


def test_a_hot_key_is_split_when_joined(spark):
    """Adaptive execution deals the rows of a hot key out over several tasks."""
    held = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        rows = spark.range(0, 200_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997).alias("k"), "id"
        )
        lookup = spark.range(997).select(F.col("id").alias("k"), F.col("id").alias("v"))
        joined = J.lookup_join(rows, lookup, "k").withColumn("task", F.spark_partition_id())
        # all keys: a filter on one would go below the join
        hot = [r for r in joined.groupBy("k", "task").count().collect() if r.k == 0]
        assert len(hot) > 1 and sum(r["count"] for r in hot) >= 66_667
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_lookup_join_rejects_other_kinds(lopsided):
    with pytest.raises(ValueError):
        J.lookup_join(lopsided, lopsided, "k", "outer")


def test_distinct_counts(spark):
    rows = [("a", 1), ("a", -1), ("a", 1), ("a", 0), ("a", None), ("b", -7), ("b", -7)]
    df = spark.createDataFrame(rows, "k string, c int")
    signed = ST.signed_distinct_count(df, "k", "c", "n", "n_abs")
    # NULL counts as one value, 1 and -1 share a magnitude
    assert rows_of(signed) == [("a", 4, 3), ("b", 1, 1)]
    assert rows_of(ST.distinct_count(df, "k", "c", "n")) == [("a", 4), ("b", 1)]


def test_vote_tie_goes_to_the_smallest(spark):
    rows = [(1, "a", 5), (2, "a", 4), (3, "a", 5), (4, "a", 4), (5, "b", 21), (6, "b", 1), (7, "b", 21)]
    df = spark.createDataFrame(rows, "id int, k string, label int")
    expected = [(i, k, 4 if k == "a" else 21) for i, k, _ in rows]
    assert rows_of(ST.vote(df, "k", "label").select("id", "k", "label")) == expected
    words = df.withColumn("label", F.lpad(F.col("label").cast("string"), 2, "0"))
    wanted = [(i, k, f"{label:02d}") for i, k, label in expected]
    assert rows_of(ST.vote(words, "k", "label").select("id", "k", "label")) == wanted


def test_vote_ignores_row_order(spark):
    rows = [(i, i % 3, (i * 7) % 4) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, k int, label int")
    back = spark.createDataFrame(rows[::-1], "id int, k int, label int")
    assert rows_of(ST.majority(df, "k", "label")) == rows_of(ST.majority(back, "k", "label"))


def test_labels_have_to_agree(spark):
    rows = [("a", 1), ("a", 1), ("a", None), ("b", 1), ("b", 2), ("c", None)]
    df = spark.createDataFrame(rows, "k string, label int")
    assert rows_of(ST.agreement(df, "k", "label")) == [("a", 1, True), ("b", 2, False), ("c", 0, True)]
    ST.require_agreement(df.filter("k != 'b'"), "k", "label")
    with pytest.raises(ValueError, match="'b'"):
        ST.require_agreement(df, "k", "label")


def test_means_can_be_rounded(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 0.0), ("a", 0.0)], "k string, x double")
    r = ST.group_stats(df, "k", [ST.Stat("x", "x", ("mean", "std"), 3)]).first()
    assert r.k_x_mean == 0.333 and r.k_x_std != round(r.k_x_std, 3)


def test_event_statistics_agree_with_the_attached_ones(spark, sf_dir):
    kinds = ("max", "min", "mean")
    columns = ["event_id", "event_id_count", "event_id_mass_sum", "event_id_px_max",
               "event_id_angle_xy_min", "event_id_speed"]
    jets = V.jets(spark, sf_dir)
    attached = jet_table(jets, kinds, 6).select(*columns).distinct()
    assert rows_of(event_stats(jets, kinds, 6).select(*columns)) == rows_of(attached)


def test_events_of_many_children_keep_their_counts(spark):
    """Counts and codes above 32,767 are no less exact than small ones."""
    jets = spark.range(40_000).select(
        F.col("id").alias("jet_id"),
        F.lit(1).alias("event_id"),
        F.lit(70_000).alias("number_of_particles_in_this_jet"),
        *[F.lit(float(n)).alias(f"jet_{c}") for n, c in enumerate(("px", "py", "pz", "energy", "mass"), 1)],
        F.lit(21).alias("label"),
        F.lit("train").alias("split"),
    )
    particles = spark.createDataFrame(
        [(0, 1000020040, 1.0, 2.0, 3.0, 4.0, 5.0, 1)],
        "jet_id long, particle_category int, particle_px double, particle_py double,"
        " particle_pz double, particle_energy double, particle_mass double, line_number int",
    )
    events = spark.createDataFrame([(1, 40_000)], "event_id int, number_of_jet_in_this_event int")
    (row,) = event_table(particles, jets, events, ["line_number"], k_particles=2, k_jets=2).collect()
    assert row.event_id_count == 40_000 and row.event_id_number_particles_max == 70_000
    assert row.j0_number_of_particles_in_this_jet == 70_000
    assert row.j0_p0_particle_category == 1000020040


def test_particles_are_shuffled_raw_before_the_statistics_of_their_jet(spark, monkeypatch):
    data = [
        (None if n % 41 == 0 else n % 23 if n % 2 else 5, n % 7 - 3 if n % 13 else None,
         *[float((n * m) % 19 - 9) if n % 17 else None for m in (1, 3, 5, 7, 11)])
        for n in range(1500)
    ]
    axes = "particle_px double, particle_py double, particle_pz double"
    particles = spark.createDataFrame(
        data, f"jet_id long, particle_category int, {axes}, particle_energy double, particle_mass double"
    ).repartition(5)
    for chosen in (COMPACT, BROAD):
        together = jet_stats(particles, chosen, 6)
        plan = plan_of(together)
        assert "REBALANCE_PARTITIONS_BY_COL" in plan
        # nothing but the raw rows travels
        assert plan.count("Exchange ") == plan.count("REBALANCE_PARTITIONS_BY_COL")
        want = rows_of(stored(together), "jet_id")
        for limit in (40, 0):
            monkeypatch.setattr(ST, "HOT_ROWS", limit)
            hot = jet_stats(particles, chosen, 6)
            assert hot.columns == together.columns
            assert len(want) == 23 and [pytest.approx(r, nan_ok=True) for r in want] == rows_of(stored(hot), "jet_id")
        monkeypatch.undo()
