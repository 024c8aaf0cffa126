import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, rows_of
from tierframe.catalog.table_queries import bucketed_join
from tierframe.sources import views as V
from tierframe.sources.bucketed import open_bucketed, write_bucketed


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_join_and_grouping_need_no_exchange(spark, sf_dir, no_broadcast):
    assert "Exchange" not in plan_of(bucketed_join(spark, sf_dir))


def test_jets_with_particles(spark, sf_dir, tmp_path, no_broadcast):
    particles, jets = V.particles(spark, sf_dir), V.jets(spark, sf_dir)
    by_jet = write_bucketed(particles, str(tmp_path / "p"), "jet_id", 4)
    jets_by_jet = write_bucketed(jets, str(tmp_path / "j"), "jet_id", 4)
    with_particles = jets_by_jet.join(by_jet.select("jet_id"), "jet_id", "left_semi")
    assert "Exchange" not in plan_of(with_particles)
    expected = jets.join(particles.select("jet_id"), "jet_id", "left_semi")
    assert rows_of(with_particles) == rows_of(expected)


def test_opened_again(spark, sf_dir, tmp_path, no_broadcast):
    path = str(tmp_path / "j")
    jets = V.jets(spark, sf_dir)
    written = write_bucketed(jets, path, "event_id", 4)
    again = open_bucketed(spark, path, written.schema, "event_id", 4)
    counts = again.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))
    assert "Exchange" not in plan_of(counts)
    assert rows_of(counts) == rows_of(jets.groupBy("event_id").agg(F.count(F.lit(1)).alias("n")))


def test_a_key_that_is_null(spark, tmp_path):
    df = spark.createDataFrame([(None, 1), (1, 2), (None, 3)], "k int, v int")
    back = write_bucketed(df, str(tmp_path / "t"), "k", 3)
    assert rows_of(back, "v") == [(None, 1), (1, 2), (None, 3)]


def test_a_written_path_is_not_written_again(spark, tmp_path):
    df = spark.createDataFrame([(1, 1)], "k int, v int")
    write_bucketed(df, str(tmp_path / "t"), "k", 2)
    with pytest.raises(Exception, match="(?i)exist|not empty"):
        write_bucketed(df, str(tmp_path / "t"), "k", 2)
