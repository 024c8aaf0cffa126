"""Session settings the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# ANSI mode stays on: the functions use try_divide and try_cast.  AQE merges
# small shuffle partitions and splits the large ones of a join.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even if what follows needs a shuffle for it
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # covers the 260 event statistics, which run twice as fast when compiled; the
    # flattened tables are wider than generated methods may get
    "spark.sql.codegen.maxFields": "600",
    # no call-site capture per Column operation; plans here hold thousands
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app: str = "tierframe",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings above; on a cluster leave ``master`` unset.

    ``shuffle_partitions`` should put 100-200 MB into a partition of the
    largest shuffle; AQE only merges partitions, so choose it too high rather
    than too low.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
