"""Tables that are stored by key, so that joins and groupings on it need no shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Write one sorted file per bucket of ``key`` and return the table on it.

    The rows are shuffled once, here; tables written with the same number of
    buckets are then joined bucket by bucket.  Choose the number for 100-200 MB
    a bucket of the largest table.  All rows of a key share a bucket, and
    a join without a shuffle cannot be split by adaptive execution: use it for
    keys of bounded groups, such as the particles of a jet or the jets of an event.
    """
    name = _new_name()
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    writer.mode("errorifexists").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def open_bucketed(
    spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int
) -> DataFrame:
    """A table that ``write_bucketed`` left at ``path``, in another session.

    Schema, key and number of buckets must be those it was written with.
    """
    name = _new_name()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet"
        f" CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def _new_name() -> str:
    return f"bucketed_{uuid.uuid4().hex}"
