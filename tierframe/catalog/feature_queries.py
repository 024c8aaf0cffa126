"""Features, group statistics, top-k, flattening and the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierframe.operators.columns import cast_columns, narrow
from tierframe.operators.slots import flatten, top_k
from tierframe.operators.stats import Stat, distinct_count, signed_distinct_count, with_group_stats
from tierframe.plans import event_table as E
from tierframe.plans import jets as J
from tierframe.plans import particles as P
from tierframe.sources import views as V

# means are compared with another engine, which adds in another order
DIGITS = 6
PARTICLE_ID = ["jet_id", "line_number", "part_key", "supplier_key"]


def stored(df: DataFrame) -> DataFrame:
    """double -> float, as the feature tables are stored; other types stay."""
    return narrow(df, keep=[c for c, t in df.dtypes if t != "double"])


def labelled(df: DataFrame, *names: str) -> DataFrame:
    """A label that is NULL in the test rows as double, like any client that
    has no nullable integers shows it."""
    return cast_columns(df, names or ["label"], "double")


def particle_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    featured = P.particle_features(V.particles(spark, sf_dir))
    return stored(
        featured.select(
            *PARTICLE_ID, *P.RAW, "particle_category_abs", *P.COMPACT.features
        )
    )


def particle_features_broad(spark: SparkSession, sf_dir: str) -> DataFrame:
    featured = P.particle_features(V.particles(spark, sf_dir), P.BROAD.features)
    return stored(featured.select(*PARTICLE_ID, *P.BROAD.features))


def jet_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(stored(J.jet_features(V.jets(spark, sf_dir))))


def jet_id_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = P.particle_table(V.particles(spark, sf_dir))
    return stored(table.select(*PARTICLE_ID, *P.COMPACT.stat_names()))


def jet_id_stats_broad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(P.jet_stats(V.particles(spark, sf_dir), P.BROAD, DIGITS))


def jet_id_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    particles = V.particles(spark, sf_dir).select(*PARTICLE_ID, "particle_px")
    every = ("count", "max", "mean", "min", "std", "sum")
    return stored(
        with_group_stats(particles, "jet_id", [Stat("particle_px", "px", every)])
    )


def category_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signed_distinct_count(
        V.particles(spark, sf_dir), "jet_id", "particle_category", "n_signed", "n_abs"
    )


def distinct_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_count(V.particles(spark, sf_dir), "jet_id", "supplier_key", "n_distinct")


def event_id_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(stored(J.jet_table(V.jets(spark, sf_dir), digits=DIGITS)))


def event_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = J.event_stats(V.jets(spark, sf_dir), kinds=())
    return stored(
        stats.select(
            "event_id", "event_id_count", "event_id_energy_sum", "event_id_mass_sum",
            "event_id_speed",
        )
    )


def topk_particles(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = E.by_magnitude("particle_px", V.PARTICLE_TIES)
    top = top_k(V.particles(spark, sf_dir), "jet_id", order, 4)
    return top.select(*PARTICLE_ID, "particle_px", "slot")


def topk_jets(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = top_k(V.jets(spark, sf_dir), "event_id", E.by_magnitude("jet_px", ["jet_id"]), 4)
    return top.select("event_id", "jet_id", "jet_px", "slot")


def flatten_particles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.flat_particles(V.particles(spark, sf_dir), V.PARTICLE_TIES)


def flatten_particles_broad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.flat_particles(V.particles(spark, sf_dir), V.PARTICLE_TIES, P.BROAD, 16, DIGITS)


def flatten_jets(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["number_of_particles_in_this_jet", "jet_px", "jet_energy", "jet_mass"]
    return stored(
        flatten(
            V.jets(spark, sf_dir),
            "event_id",
            E.by_magnitude("jet_px", ["jet_id"]),
            columns,
            4,
            "j",
        )
    )


def event_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = (V.particles(spark, sf_dir), V.jets(spark, sf_dir), V.events(spark, sf_dir))
    return labelled(E.event_table(*tables, V.PARTICLE_TIES, digits=DIGITS))


def event_table_broad(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = (V.particles(spark, sf_dir), V.jets(spark, sf_dir), V.events(spark, sf_dir))
    return labelled(E.event_table(*tables, V.PARTICLE_TIES, P.BROAD, k_particles=16, digits=DIGITS))


def leading_particles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jets with their statistics and four leading particles."""
    flat = E.flat_particles(V.particles(spark, sf_dir), V.PARTICLE_TIES, k=4)
    jets = V.jets(spark, sf_dir).select("jet_id", "event_id", "jet_energy")
    return stored(jets.join(flat, "jet_id"))


QUERIES = {
    f.__name__: f
    for f in (
        particle_features,
        particle_features_broad,
        jet_features,
        jet_id_stats,
        jet_id_stats_broad,
        jet_id_count,
        category_distinct,
        distinct_per_key,
        event_id_stats,
        event_speed,
        topk_particles,
        topk_jets,
        flatten_particles,
        flatten_particles_broad,
        flatten_jets,
        event_table,
        event_table_broad,
        leading_particles,
    )
}
