"""Landing layer: headered CSV files, one per entity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starlift.sources.records import DIALECT, has_broken_lines, parsed
from starlift.sources.schemas import schema_for

# How landing parts are written. They are read a few times and then replaced, so
# the fastest level of gzip is the right one: a third of the time for an eighth more bytes.
WRITING = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def discover_csv(spark: SparkSession, folder: str) -> dict[str, str]:
    """Entity name -> path of every ``*.csv`` in ``folder``, a file or a folder of parts."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/*.csv")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    paths = [status.getPath() for status in found]
    return {path.getName().removesuffix(".csv"): path.toString() for path in paths}


def publish_csv(rows: DataFrame, folder: str, entity: str) -> None:
    """Write ``rows`` as the entity's landing CSV, replacing what is there. The parts are
    compressed, which a reader sees by their names; each is what one task wrote."""
    rows.write.mode("overwrite").options(**DIALECT, **WRITING).csv(f"{folder.rstrip('/')}/{entity}.csv")


def _header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.options(**DIALECT).csv(path).columns


def _read(spark: SparkSession, path: str, schema: T.StructType, multiline: bool, **options: str) -> DataFrame:
    """The rows of a CSV file or a folder of parts. Lines that are no rows of their own,
    because a quoted value goes over their end, are put together first (``records``)."""
    if not multiline and has_broken_lines(spark, path):
        return parsed(spark, path, schema, **options)
    reader = spark.read.schema(schema).options(**DIALECT).options(**options)
    return reader.option("multiLine", multiline).option("enforceSchema", False).csv(path)


def copy_csv(spark: SparkSession, path: str, folder: str, entity: str, multiline: bool = False) -> None:
    """Publish a CSV file, or a folder of parts, with every value as the text it was.

    Rows with more or fewer values than the header has are refused, and so are parts
    whose header is another one: their columns would get into each other's place.
    """
    schema = T.StructType([T.StructField(column, T.StringType()) for column in _header(spark, path)])
    publish_csv(_read(spark, path, schema, multiline, mode="FAILFAST"), folder, entity)


def read_landing(
    spark: SparkSession,
    folder: str,
    entity: str,
    types: str | None = None,
    null_marker: str | None = None,
    multiline: bool = False,
    mode: str = "FAILFAST",
) -> DataFrame:
    """All columns of an entity's landing CSV, with declared types.

    Only the header line is read to learn the columns; there is no inference pass.
    Files are split over tasks, also where there are line breaks inside quotes, which
    one look over the lines finds out; ``multiline`` leaves out the look and has every
    file read by one task.
    """
    path = f"{folder.rstrip('/')}/{entity}.csv"
    schema = schema_for(entity, _header(spark, path), types)
    options = {"mode": mode} | ({} if null_marker is None else {"nullValue": null_marker})
    return _read(spark, path, schema, multiline, **options)
