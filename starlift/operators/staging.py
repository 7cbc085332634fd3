"""Intermediate results as parquet in the cluster's shared folder.

A staged table cuts the lineage, survives the loss of executors, keeps column
pruning, and gives the planner true sizes for its broadcast decisions.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}


def staging_root(spark: SparkSession) -> str:
    """The shared folder the session names; a temporary one only on a local master."""
    shared = spark.conf.get(_SETTING, None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="starlift-")
        atexit.register(shutil.rmtree, _local_roots[context.applicationId], ignore_errors=True)
    return _local_roots[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path of its own under the shared folder."""
    return f"{staging_root(spark)}/starlift/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stage(rows: DataFrame, label: str, folder: str | None = None, **options: str) -> DataFrame:
    """Write ``rows`` and read them back. ``folder`` groups stages to discard together,
    ``options`` go to the writer."""
    spark = rows.sparkSession
    path = f"{folder}/{label}-{uuid.uuid4().hex}" if folder else new_folder(spark, label)
    rows.write.options(**options).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a staging folder made by ``new_folder``."""
    if not folder.startswith(f"{staging_root(spark)}/starlift/"):
        raise ValueError(f"not a staging folder: {folder}")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
