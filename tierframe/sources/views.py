"""The three levels as views on the star-schema tables.

customer is the event, orders the jet, lineitem the particle.  The values are
signed, with zeros and negatives, and whole numbers where sums should be exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierframe.functions.classes import N_CLASSES

# orders the particles of a jet that are equal in the sort column
PARTICLE_TIES = ["line_number", "part_key", "supplier_key", "price", "shipped"]
MODELS = ["lgb", "xgb", "cat", "nn"]
TEST_NATIONS_FROM = 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def particles(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber")
    # + 0.0 turns a rounded -0.0 into 0.0
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("jet_id"),
        F.when(F.col("l_returnflag") == "R", -line).otherwise(line).alias("particle_category"),
        (F.col("l_quantity") - 25).alias("particle_px"),
        (line - 4).cast("double").alias("particle_py"),
        (F.round(F.col("l_discount") * 100) - 5 + 0.0).alias("particle_pz"),
        (F.round(F.col("l_extendedprice") * 100) + 0.0).alias("particle_energy"),
        (F.round(F.col("l_tax") * 100) - 2 + 0.0).alias("particle_mass"),
        line.alias("line_number"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_suppkey").alias("supplier_key"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_shipdate").alias("shipped"),
    )


def _label(event_id: str):
    key = F.col(event_id) % 4
    return F.when(key == 0, 21).when(key == 1, 1).when(key == 2, 4).otherwise(5)


def _split():
    return F.when(F.col("c_nationkey") >= TEST_NATIONS_FROM, "test").otherwise("train")


def _train_label(event_id: str):
    return F.when(F.col("c_nationkey") < TEST_NATIONS_FROM, _label(event_id)).cast("int")


def jets(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = particles(spark, sf_dir).groupBy("jet_id").agg(
        F.count(F.lit(1)).cast("int").alias("n"),
        *[
            F.sum(f"particle_{c}").alias(f"jet_{c}")
            for c in ("px", "py", "pz", "energy", "mass")
        ],
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("jet_id"), F.col("o_custkey").alias("event_id")
    )
    return (
        orders.join(sums, "jet_id", "left")
        .join(customer, F.col("event_id") == F.col("c_custkey"))
        .select(
            "jet_id",
            "event_id",
            F.coalesce("n", F.lit(0)).alias("number_of_particles_in_this_jet"),
            "jet_px",
            "jet_py",
            "jet_pz",
            "jet_energy",
            "jet_mass",
            _train_label("event_id").alias("label"),
            _split().alias("split"),
        )
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).cast("int").alias("n")
    )
    return (
        table(spark, sf_dir, "customer")
        .join(orders, "c_custkey", "left")
        .select(
            F.col("c_custkey").alias("event_id"),
            F.coalesce("n", F.lit(0)).alias("number_of_jet_in_this_event"),
            _train_label("c_custkey").alias("label"),
            _split().alias("split"),
        )
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, model, label, split, w0..w3, probs): four models score each event."""
    key, model = F.col("c_custkey"), F.col("m")
    weights = [
        (
            (key * (2 * model + 3) + 31 * k) % 97
            + F.when(key % N_CLASSES == k, 40).otherwise(0)
        ).alias(f"w{k}")
        for k in range(N_CLASSES)
    ]
    named = F.get(F.array(*[F.lit(m) for m in MODELS]), F.col("m"))
    weighted = (
        table(spark, sf_dir, "customer")
        .select(
            "c_custkey", "c_nationkey", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("m")
        )
        .select(
            F.col("c_custkey").alias("id"),
            named.alias("model"),
            _train_label("c_custkey").alias("label"),
            _split().alias("split"),
            *weights,
        )
    )
    total = sum(F.col(f"w{k}") for k in range(N_CLASSES))
    return weighted.withColumn(
        "probs", F.array(*[F.col(f"w{k}") / total for k in range(N_CLASSES)])
    )
