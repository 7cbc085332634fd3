"""The calendar dimension: one row per day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlift.functions.expressions import date_id


def calendar(bounds: DataFrame) -> DataFrame:
    """All days of a one-row frame's ``first_day`` .. ``last_day``, both included.

    The days have no gaps, so the position in the series is the surrogate key
    that a row_number over ``date_id`` would give.
    """
    days = bounds.select(F.posexplode(F.expr("sequence(first_day, last_day, interval 1 day)")).alias("pos", "day"))
    return days.select(
        (F.col("pos") + 1).cast("long").alias("date_sk"),
        date_id("day").alias("date_id"),
        F.col("day").cast("timestamp_ntz").alias("date"),
        F.year("day").cast("long").alias("year"),
        F.month("day").cast("long").alias("month"),
        F.dayofmonth("day").cast("long").alias("day"),
    )


def calendar_between(spark: SparkSession, first_day: date, last_day: date) -> DataFrame:
    return calendar(spark.range(1).select(F.lit(first_day).alias("first_day"), F.lit(last_day).alias("last_day")))
