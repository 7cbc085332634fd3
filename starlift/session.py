"""Session settings for local runs and for large clusters."""

from __future__ import annotations

from pyspark.sql import SparkSession

# What the jobs here rely on, at cluster scale. AQE splits hot join partitions and
# coalesces small ones, so the partition count is set for the largest shuffle; it also
# skips the sort of a join whose build partitions turn out small enough to hash. A task
# with a few months to write keeps their files open side by side instead of sorting.
CLUSTER_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.shuffle.partitions": "40000",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "64m",
}


# The same on one machine: smaller partitions, so that all cores share a hot key.
LOCAL_SETTINGS = CLUSTER_SETTINGS | {
    "spark.ui.enabled": "false",
    "spark.driver.memory": "8g",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "16m",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def apply_settings(spark: SparkSession) -> None:
    """Put the settings in force that the session's user has not set. On a local master
    those for one machine, with a shuffle partition per core."""
    context = spark.sparkContext
    chosen = CLUSTER_SETTINGS
    if context.master.startswith("local"):
        chosen = LOCAL_SETTINGS | {"spark.sql.shuffle.partitions": str(context.defaultParallelism)}
    given = {name for name, _ in context.getConf().getAll()}
    for name, value in chosen.items():
        if name.startswith("spark.sql.") and name not in given:
            spark.conf.set(name, value)


def local_session(app: str = "starlift", cores: int | str = 8, **settings: str) -> SparkSession:
    """A session on this machine; ``settings`` are named with ``__`` for each dot."""
    chosen = LOCAL_SETTINGS | {"spark.sql.shuffle.partitions": str(cores)}
    chosen |= {name.replace("__", "."): value for name, value in settings.items()}
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    session = builder.config(map=chosen).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
