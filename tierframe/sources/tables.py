"""Schemas, scans and sinks of the three-level data set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierframe.functions.scalar import nan_to_null


def _schema(ids: list[str], ints: list[str], doubles: list[str], id_type: T.DataType):
    return T.StructType(
        [T.StructField(c, id_type) for c in ids]
        + [T.StructField(c, T.IntegerType()) for c in ints]
        + [T.StructField(c, T.DoubleType()) for c in doubles]
    )


def particle_schema(id_type: T.DataType = T.StringType()) -> T.StructType:
    return _schema(
        ["jet_id"],
        ["particle_category"],
        ["particle_px", "particle_py", "particle_pz", "particle_energy", "particle_mass"],
        id_type,
    )


def jet_schema(id_type: T.DataType = T.StringType(), labelled: bool = True) -> T.StructType:
    schema = _schema(
        ["jet_id", "event_id"],
        ["number_of_particles_in_this_jet"],
        ["jet_px", "jet_py", "jet_pz", "jet_energy", "jet_mass"],
        id_type,
    )
    return schema.add("label", T.IntegerType()) if labelled else schema


def event_schema(id_type: T.DataType = T.StringType()) -> T.StructType:
    return _schema(["event_id"], ["number_of_jet_in_this_event"], [], id_type)


def sample_schema(id_type: T.DataType = T.StringType()) -> T.StructType:
    return _schema(["id"], ["label"], [], id_type)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header row.  Columns are found by header name, so a file may
    have more of them and in another order; NaN becomes NULL here, once.

    All files of a path share one header.  A missing column is an error here, a
    cell that does not fit its type or a header unlike the first one when the
    rows are read.
    """
    header = spark.read.option("header", True).csv(path).columns
    known = {f.name: f.dataType for f in schema.fields}
    if absent := sorted(set(known) - set(header)):
        raise ValueError(f"{path} lacks the columns {', '.join(absent)}")
    in_file = T.StructType([T.StructField(c, known.get(c, T.StringType())) for c in header])
    df = (
        spark.read.schema(in_file)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
        .select(*known)
    )
    reals = [f.name for f in schema.fields if isinstance(f.dataType, T.FractionalType)]
    return df.withColumns({c: nan_to_null(F.col(c)) for c in reals}) if reals else df


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV part files, each with the header."""
    df.write.mode("errorifexists").option("header", True).csv(path)


def read_table(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Stage table; ``split`` prunes the partitions of the other origin."""
    df = spark.read.parquet(path)
    return df if split is None else df.filter(F.col("split") == split)


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Stage table, partitioned by origin where the column exists."""
    writer = df.write.mode(mode)
    if "split" in df.columns:
        writer = writer.partitionBy("split")
    writer.parquet(path)
