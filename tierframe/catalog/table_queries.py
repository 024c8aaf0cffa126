"""Projections, unions, labels, files and submissions."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierframe.catalog.feature_queries import DIGITS, labelled, stored
from tierframe.functions.classes import (
    N_CLASSES,
    argmax,
    class_to_label,
    label_to_class,
    one_hot,
)
from tierframe.operators import columns as C
from tierframe.operators.group_state import group_state, merge_states, stats_of
from tierframe.operators.narrowing import number_types, read_csv_inferred
from tierframe.operators.own import OwnAggregate, with_row_function
from tierframe.operators.profile import describe, importance_report, melt, table_profile
from tierframe.operators.slots import flatten
from tierframe.operators.stats import Stat, agreement, distinct_keys, vote, with_digits
from tierframe.plans import event_table as E
from tierframe.plans.jets import jet_features, jet_table
from tierframe.plans.submission import fan_out, fill_sample, predicted_labels
from tierframe.sources import predictions as PR
from tierframe.sources import tables as IO
from tierframe.sources import views as V
from tierframe.sources.bucketed import write_bucketed
from tierframe.sources.staging import staging_path

LONG = T.LongType()
JET_RAW = [
    "number_of_particles_in_this_jet", "jet_px", "jet_py", "jet_pz", "jet_energy", "jet_mass",
]


def _parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    jets = V.jets(spark, sf_dir)
    return C.rows_of(jets, "train"), C.rows_of(jets, "test").drop("label")


# files


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "particle_csv")
    names = IO.particle_schema().fieldNames()
    IO.write_csv(V.particles(spark, sf_dir).select(*names), path)
    return IO.read_csv(spark, path, IO.particle_schema(LONG))


def csv_column_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "jet_csv")
    IO.write_csv(V.jets(spark, sf_dir).drop("split"), path)
    jets = IO.read_csv(spark, path, IO.jet_schema(LONG))
    return labelled(jets.select("jet_id", "event_id", "label"))


def event_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "event_csv")
    IO.write_csv(V.events(spark, sf_dir).drop("label", "split"), path)
    return IO.read_csv(spark, path, IO.event_schema(LONG))


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "jets")
    IO.write_table(V.jets(spark, sf_dir), path)
    return IO.read_table(spark, path, "test").select("jet_id", "event_id", *JET_RAW, "split")


def predictions_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "predictions")
    PR.write_predictions(
        V.predictions(spark, sf_dir).select("id", "probs", "model", "split"), path
    )
    back = PR.read_predictions(spark, path, ["lgb", "nn"], "train")
    return back.select("id", "model", *PR.probability_columns())


def predictions_every_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four models, train and test, written and read again."""
    path = staging_path(spark, "predictions")
    PR.write_predictions(V.predictions(spark, sf_dir).select("id", "probs", "model", "split"), path)
    back = PR.read_predictions(spark, path, V.MODELS)
    return back.select("id", "model", "split", *PR.probability_columns())


def probability_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "probabilities")
    averaged = V.predictions(spark, sf_dir).filter("model = 'cat' and split = 'test'")
    IO.write_csv(averaged.select("id", *PR.probability_columns()), path)
    schema = "id long, p1 double, p2 double, p3 double, p4 double"
    return spark.read.schema(schema).option("header", True).csv(path)


def wide_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "flat_jets")
    flat = flatten(
        V.jets(spark, sf_dir),
        "event_id",
        E.by_magnitude("jet_px", ["jet_id"]),
        JET_RAW,
        4,
        "j",
    )
    IO.write_csv(flat, path)
    return spark.read.schema(flat.schema).option("header", True).csv(path)


def submission_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "submission")
    winners = predicted_labels(
        V.predictions(spark, sf_dir).filter("model = 'lgb' and split = 'test'"), "id"
    ).withColumnRenamed("id", "event_id")
    test = _parts(spark, sf_dir)[1]
    IO.write_csv(fan_out(test, winners).select("id", "label"), path)
    return IO.read_csv(spark, path, IO.sample_schema(LONG))


def sample_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = V.events(spark, sf_dir).select(F.col("event_id").alias("id"))
    winners = predicted_labels(
        V.predictions(spark, sf_dir).filter("model = 'xgb' and split = 'test'"), "id"
    )
    return labelled(fill_sample(sample, winners))


def _dated_particles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.particles(spark, sf_dir).withColumn("shipped", F.col("shipped").cast("date"))


def _type_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    rows = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    return spark.createDataFrame(rows, "column_name string, type_name string")


def csv_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types found in a CSV file that nothing is told about."""
    path = staging_path(spark, "untyped_csv")
    IO.write_csv(_dated_particles(spark, sf_dir), path)
    return _type_table(spark, read_csv_inferred(spark, path).schema)


def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Its rows; the widths, which depend on the values, are levelled again."""
    path = staging_path(spark, "untyped_csv")
    IO.write_csv(_dated_particles(spark, sf_dir), path)
    found = read_csv_inferred(spark, path)
    wide = {"tinyint": "bigint", "smallint": "bigint", "int": "bigint", "float": "double"}
    return found.select(*[F.col(c).cast(wide.get(t, t)).alias(c) for c, t in found.dtypes])


def narrowest_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    jets = V.jets(spark, sf_dir).withColumn("third", F.col("jet_energy") / 3)
    return _type_table(spark, number_types(jets))


def bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jets and particles stored by jet: grouped and joined without a shuffle."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tables = {"particles": V.particles(spark, sf_dir), "jets": V.jets(spark, sf_dir)}
    stored_by_jet = {
        name: write_bucketed(table, staging_path(spark, name), "jet_id", buckets)
        for name, table in tables.items()
    }
    strongest = stored_by_jet["particles"].groupBy("jet_id").agg(
        F.count(F.lit(1)).alias("n_particles"), F.max("particle_energy").alias("most_energy")
    )
    joined = stored_by_jet["jets"].join(strongest.hint("merge"), "jet_id", "left")
    joined = joined.fillna(0, subset=["n_particles"])
    return joined.select("jet_id", "event_id", "jet_energy", "n_particles", "most_energy")


# columns


def select_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.select_except(V.jets(spark, sf_dir), ["event_id", "label", "split"])


def select_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = jet_table(V.jets(spark, sf_dir), kinds=("max", "min"))
    wanted = C.names_with_prefix(table, "event_id_number")
    return table.select("jet_id", *wanted)


def select_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten(
        V.jets(spark, sf_dir), "event_id", E.by_magnitude("jet_px", ["jet_id"]), JET_RAW, 3, "j"
    )
    return flat.select("event_id", *C.names_matching(flat, r"j\d+_jet_p"))


def reindex_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.reindex(V.jets(spark, sf_dir), ["jet_px", "jet_id", "not_there", "event_id"])


def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.move_last(V.jets(spark, sf_dir).drop("label", "split", "jet_mass"), ["jet_id"])


def rename_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots to columns of a model matrix: c4.. for the second model."""
    second = V.predictions(spark, sf_dir).filter("model = 'xgb'")
    matrix = second.select(*PR.probability_columns())
    named = C.rename_all(matrix, "c{i}", 4)
    keyed = second.select("id", *PR.probability_columns("probs", "c", 4))
    return keyed.select("id", *named.columns)


def narrow_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    particles = V.particles(spark, sf_dir).drop("line_number", "price", "shipped")
    wide = particles.withColumn("too_wide", F.col("jet_id") * 4)
    return C.narrow(wide, keep=["jet_id", "part_key", "supplier_key"])


def cast_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = E.by_magnitude("particle_px", V.PARTICLE_TIES)
    flat = flatten(
        V.particles(spark, sf_dir).withColumn(
            "particle_category", F.col("particle_category").cast("float")
        ),
        "jet_id",
        order,
        ["particle_category"],
        6,
        "p",
    )
    return C.cast_columns(flat, C.names_matching(flat, r"p\d+_particle_category"), "int")


def fill_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.fill_null(V.jets(spark, sf_dir).select("jet_id", *JET_RAW, "label"))


def keep_one_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten(
        V.jets(spark, sf_dir),
        "event_id",
        E.by_magnitude("jet_px", ["jet_id"]),
        ["label", "jet_energy"],
        4,
        "j",
    )
    return labelled(C.keep_one(flat, [f"j{i}_label" for i in range(4)], "label"))


# rows


def train_test_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    stacked = C.stack_splits(*_parts(spark, sf_dir))
    return labelled(stacked.select("jet_id", "event_id", "jet_energy", "label", "split"))


def train_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    stacked = C.stack_splits(*_parts(spark, sf_dir))
    return stored(C.rows_of(jet_features(stacked), "train").select("jet_id", "jet_speed", "label"))


def drift_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.stack_targets(*_parts(spark, sf_dir), ["jet_id", *JET_RAW])


def distinct_event_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_keys(V.jets(spark, sf_dir), "event_id")


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_profile(V.jets(spark, sf_dir))


def label_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event: how many labels its jets carry, and whether that is at most one."""
    return agreement(V.jets(spark, sf_dir), "event_id", "label")


def status_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same check on a column that does differ inside a group."""
    particles = V.particles(spark, sf_dir)
    return agreement(particles, "supplier_key", "particle_category")


STATE_KEY = "number_of_particles_in_this_jet"


def merged_group_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jets by their number of particles: the state of the train jets is written and
    that of the test jets merged into it."""
    names = [c for c in JET_RAW if c != STATE_KEY]
    every = ("count", "max", "mean", "min", "std", "sum")
    stats = with_digits([Stat(c, c.removeprefix("jet_"), every) for c in names], DIGITS)
    train, test = (group_state(part, STATE_KEY, names) for part in _parts(spark, sf_dir))
    path = staging_path(spark, "state")
    IO.write_table(train, path)
    return stored(stats_of(merge_states([IO.read_table(spark, path), test], STATE_KEY), STATE_KEY, stats))


def describe_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(describe(V.jets(spark, sf_dir), JET_RAW))


def importance_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a positive value as the weight of each raw column."""
    weight = (
        melt(V.jets(spark, sf_dir), JET_RAW)
        .groupBy(F.col("column_name").alias("feature"))
        .agg(F.count_if(F.col("value") > 0).alias("gain"))
    )
    return importance_report(weight, 5).withColumn("share", F.round("share", 6))


# labels


def label_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = V.events(spark, sf_dir)
    mapped = events.select(
        "event_id",
        "label",
        label_to_class(F.col("label")).alias("class"),
        class_to_label(label_to_class(F.col("label"))).alias("back"),
        label_to_class(F.col("number_of_jet_in_this_event")).alias("partial"),
    )
    return labelled(mapped, "label", "class", "back", "partial")


def argmax_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the integer weights share their maxima with the probabilities
    weights = F.array(*[F.col(f"w{k}") for k in range(N_CLASSES)])
    return V.predictions(spark, sf_dir).select("id", "model", argmax(weights).alias("class"))


def one_hot_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = label_to_class(F.col("label"))
    flags = [c.alias(f"is_{k}") for k, c in enumerate(one_hot(index))]
    return V.events(spark, sf_dir).select("event_id", *flags)


def label_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    winners = predicted_labels(
        V.predictions(spark, sf_dir).filter("model = 'lgb'"), "id"
    ).withColumnRenamed("id", "event_id")
    return fan_out(V.jets(spark, sf_dir), winners)


def event_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    guess = class_to_label(F.col("number_of_particles_in_this_jet") % N_CLASSES)
    jets = V.jets(spark, sf_dir).select("jet_id", "event_id", guess.alias("label"))
    return vote(jets, "event_id", "label")


def _seen(state: tuple, rows) -> tuple:
    """Count, mean and centred square sum with the rows of a frame."""
    values = rows.iloc[:, -1].to_numpy(float)
    values = values[~np.isnan(values)]
    mean = float(values.mean()) if len(values) else 0.0
    return _joined(state, (len(values), mean, float(((values - mean) ** 2).sum())))


def _joined(a: tuple, b: tuple) -> tuple:
    n = a[0] + b[0]
    if not n:
        return a
    apart = b[1] - a[1]
    return n, a[1] + apart * b[0] / n, a[2] + b[2] + apart * apart * a[0] * b[0] / n


# the vote and a deviation written as own aggregates
OWN_VOTE = OwnAggregate(
    start=Counter,
    add=lambda votes, rows: votes + Counter(int(v) for v in rows["label"].tolist() if not pd.isna(v)),
    merge=lambda a, b: a + b,
    finish=lambda votes: min(votes, key=lambda label: (-votes[label], label), default=None),
    type="int",
)
OWN_DEVIATION = OwnAggregate(
    start=lambda: (0, 0.0, 0.0),
    add=_seen,
    merge=_joined,
    finish=lambda s: math.sqrt(s[2] / (s[0] - 1)) if s[0] > 1 else None,
    type="double",
)


def own_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    guess = class_to_label(F.col("number_of_particles_in_this_jet") % N_CLASSES)
    jets = V.jets(spark, sf_dir).select("event_id", guess.cast("int").alias("label"))
    return OWN_VOTE.per_group(jets, "event_id", ["label"], "label")


def own_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = OWN_DEVIATION.per_group(V.jets(spark, sf_dir), "event_id", ["jet_energy"], "deviation")
    return found.select("event_id", F.round("deviation", 3).alias("deviation"))


def own_row_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    def steepness(jet) -> float | None:
        if None in jet[:3]:
            return None
        flat = math.hypot(jet.jet_px, jet.jet_py)
        return jet.jet_pz / flat if flat else None

    columns = ["jet_px", "jet_py", "jet_pz"]
    jets = V.jets(spark, sf_dir).select("jet_id", *columns)
    found = with_row_function(jets, "steepness", steepness, columns, "double")
    return found.select("jet_id", F.round("steepness", 6).alias("steepness"))


QUERIES = {
    f.__name__: f
    for f in (
        csv_roundtrip,
        csv_column_subset,
        event_csv_scan,
        parquet_roundtrip,
        predictions_roundtrip,
        predictions_every_model,
        probability_csv,
        wide_csv,
        submission_csv,
        sample_fill,
        csv_types,
        csv_inferred,
        narrowest_types,
        bucketed_join,
        select_exclude,
        select_prefix,
        select_regex,
        reindex_columns,
        drop_columns,
        rename_slots,
        narrow_cast,
        cast_slots,
        fill_null,
        keep_one_label,
        train_test_union,
        train_slice,
        drift_union,
        distinct_event_keys,
        profile,
        label_agreement,
        status_agreement,
        merged_group_stats,
        describe_columns,
        importance_share,
        label_map,
        argmax_class,
        one_hot_labels,
        label_fanout,
        event_vote,
        own_vote,
        own_deviation,
        own_row_value,
    )
}
