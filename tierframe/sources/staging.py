"""Intermediate tables that outlive the executors that computed them."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_dirs: dict[str, str] = {}


def staging_dir(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder: on a
    cluster the executors would not see it.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tierframe-")
    return _local_dirs[app]


def staging_path(spark: SparkSession, name: str) -> str:
    return f"{staging_dir(spark)}/tierframe-{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once, read many times: cuts the lineage and keeps columnar scans.

    The shuffle files behind the table go when it is written; else those of a
    job of many steps pile up until the driver happens to collect its garbage.
    The setting for it is put on once and stays, as writers may overlap.  The
    table itself stays until ``discard``, or as long as the folder does.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    if spark.conf.get(CLEAN_UP, "false") != "true":
        spark.conf.set(CLEAN_UP, "true")
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged_path = path
    return staged


def discard(*tables: DataFrame) -> None:
    """Remove the files of staged tables that nothing is going to read any more.

    Call it when whatever was made from them is written; a table that did not come
    straight from ``materialize`` is left alone.
    """
    for table in tables:
        path = getattr(table, "_staged_path", None)
        if path:
            jvm, session = table.sparkSession._jvm, table.sparkSession._jsparkSession
            # the folder around it is this table's alone
            folder = jvm.org.apache.hadoop.fs.Path(path).getParent()
            folder.getFileSystem(session.sessionState().newHadoopConf()).delete(folder, True)
            table._staged_path = None
