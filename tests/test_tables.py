"""Scans, sinks, projections and submissions."""

import os
import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, rows_of
from tierframe.operators import columns as C
from tierframe.plans.submission import fan_out, fill_sample, predicted_labels
from tierframe.sources import predictions as PR
from tierframe.sources import staging
from tierframe.sources import tables as IO


def test_csv_scan_by_header_name_with_nan(spark, tmp_path):
    path = tmp_path / "particle.csv"
    path.write_text(
        "jet_id,particle_category,particle_px,particle_py,particle_pz,particle_energy,particle_mass\n"
        "a,-11,1.5,0,-2,NaN,\n"
    )
    (row,) = IO.read_csv(spark, str(path), IO.particle_schema()).collect()
    assert tuple(row) == ("a", -11, 1.5, 0.0, -2.0, None, None)


def test_csv_columns_in_another_order(spark, tmp_path):
    path = tmp_path / "sample.csv"
    path.write_text("note,label,id\nx,21,a\ny,,b\n")
    read = IO.read_csv(spark, str(path), IO.sample_schema())
    assert read.columns == ["id", "label"] and rows_of(read) == [("a", 21), ("b", None)]


def test_csv_faults_are_errors(spark, tmp_path):
    path = tmp_path / "sample.csv"
    path.write_text("id,note\na,x\n")
    with pytest.raises(ValueError, match="label"):
        IO.read_csv(spark, str(path), IO.sample_schema())
    path = tmp_path / "bad.csv"
    path.write_text("id,label\na,abc\n")
    with pytest.raises(Exception, match="MALFORMED|BadRecord|malformed"):
        IO.read_csv(spark, str(path), IO.sample_schema()).collect()


def test_matrix_needs_each_model_once(spark):
    one, two = [0.1, 0.2, 0.3, 0.4], [0.4, 0.3, 0.2, 0.1]
    rows = [(1, "a", one), (1, "b", two), (2, "a", one), (2, "a", two), (3, "a", one),
            (4, "a", one), (4, "b", two), (4, "b", one)]
    df = spark.createDataFrame(rows, "id int, model string, probs array<double>")
    assert rows_of(PR.side_by_side(df, ["a", "b"])) == [(1, *one, *two)]


def test_csv_roundtrip(spark, tmp_path):
    path = str(tmp_path / "sub")
    df = spark.createDataFrame([("a", 21), ("b", None)], "id string, label int")
    IO.write_csv(df, path)
    assert rows_of(IO.read_csv(spark, path, IO.sample_schema())) == rows_of(df)


def test_stage_table_prunes_the_other_origin(spark, tmp_path):
    path = str(tmp_path / "stage")
    train = spark.createDataFrame([(1, 21)], "id int, label int")
    test = spark.createDataFrame([(2,)], "id int")
    IO.write_table(C.stack_splits(train, test), path)
    read = IO.read_table(spark, path, "test")
    assert rows_of(read.select("id", "label", "split")) == [(2, None, "test")]
    assert "PartitionFilters: [isnotnull(split" in plan_of(read)


def test_prediction_files(spark, tmp_path):
    path = str(tmp_path / "predictions")
    rows = [(1, [0.1, 0.2, 0.3, 0.4], "cat", "test"), (2, [1.0, 0.0, 0.0, 0.0], "nn", "train")]
    schema = "id int, probs array<double>, model string, split string"
    PR.write_predictions(spark.createDataFrame(rows, schema), path)
    read = PR.read_predictions(spark, path, ["cat"])
    assert rows_of(read.select("id", *PR.probability_columns())) == [(1, 0.1, 0.2, 0.3, 0.4)]


class Session:
    """Stands for a session on a cluster; the setting is fixed at its start."""

    def __init__(self, **settings):
        self.conf = settings


def test_staging_follows_the_session():
    session = Session(**{"spark.master": "yarn", staging.CHECKPOINT_DIR: "hdfs:///shared/"})
    assert staging.staging_path(session, "x").startswith("hdfs:///shared/tierframe-")
    assert staging.staging_path(session, "x") != staging.staging_path(session, "x")


def test_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError):
        staging.staging_dir(Session(**{"spark.master": "yarn"}))
    with pytest.raises(ValueError):
        staging.staging_dir(Session(**{"spark.master": "local-cluster[2,1,512]"}))


def test_materialize_reads_what_it_wrote(spark):
    assert staging.staging_dir(spark) == staging.staging_dir(spark)
    kept = staging.materialize(spark.range(5), "five")
    assert kept.count() == 5 and "FileScan parquet" in plan_of(kept)


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(1, 2.0, 70000, -0.0)], "id int, x double, n int, z double")


def test_name_choices(frame):
    assert C.names_except(frame, ["id", "z"]) == ["x", "n"]
    assert C.names_with_prefix(frame, "x") == ["x"]
    assert C.names_matching(frame, r"[nz]$") == ["n", "z"]
    assert C.move_last(frame, ["id"]).columns == ["x", "n", "z", "id"]
    assert C.rename_all(frame, "c{i}", 4).columns == ["c4", "c5", "c6", "c7"]


def test_reindex_adds_null_columns(frame):
    assert rows_of(C.reindex(frame, ["new", "id"])) == [(None, 1)]


def test_narrow(frame):
    narrowed = C.narrow(frame, keep=["id"])
    assert dict(narrowed.dtypes) == {"id": "int", "x": "float", "n": "int", "z": "float"}
    (row,) = narrowed.collect()
    assert (row.n, str(row.z)) == (70000, "0.0")


def test_unions(spark):
    train = spark.createDataFrame([(1, 5)], "id int, label int")
    test = spark.createDataFrame([(2,)], "id int")
    assert rows_of(C.stack_splits(train, test)) == [(1, 5, "train"), (2, None, "test")]
    assert rows_of(C.rows_of(C.stack_splits(train, test), "test")) == [(2, None)]
    assert rows_of(C.stack_targets(train, test, ["id"])) == [(1, 0), (2, 1)]


def test_fill_and_keep_one(spark):
    df = spark.createDataFrame([(1, None, 4)], "a int, b int, c int")
    assert rows_of(C.fill_null(df)) == [(1, 0, 4)]
    assert C.keep_one(df, ["a", "b"], "label").columns == ["c", "label"]


def test_submissions(spark):
    probs = spark.createDataFrame(
        [("e", [0.1, 0.1, 0.7, 0.1]), ("f", [0.4, 0.4, 0.1, 0.1])],
        "event_id string, probs array<double>",
    )
    labels = predicted_labels(probs, "event_id")
    jets = spark.createDataFrame(
        [(i, "e" if i < 20 else "f") for i in range(25)] + [(99, "g")], "jet_id int, event_id string"
    )
    expected = [(i, 4 if i < 20 else 21) for i in range(25)]
    assert rows_of(fan_out(jets, labels)) == expected
    sample = spark.createDataFrame([("f", 0), ("z", 0)], "id string, label int")
    filled = fill_sample(sample, labels.withColumnRenamed("event_id", "id"))
    assert rows_of(filled) == [("f", 21), ("z", None)]


def test_staged_tables_can_be_discarded(spark):
    from tierframe.sources.staging import discard, materialize

    kept, gone = (materialize(spark.range(5), name) for name in ("kept", "gone"))
    files = gone.inputFiles()
    # only what materialize made, and twice is once
    discard(gone, gone, kept.filter("id > 1"))
    assert kept.count() == 5
    assert not any(os.path.exists(f.removeprefix("file://")) for f in files)
