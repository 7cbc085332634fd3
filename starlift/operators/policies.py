"""Load policies: which source rows a target still needs.

Each takes and returns DataFrames; only the layer runs write.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlift.functions.expressions import moment
from starlift.operators.joins import rows_not_in


def insert_only(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Insert-only merge: source rows whose key the target lacks. Stored rows stay as
    they are, a NULL key never matches, duplicates within the source all pass."""
    return rows_not_in(source, target, equal=[key])


def merged(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """The target as it is after an insert-only merge."""
    return target.unionByName(insert_only(source, target, key))


def unseen_pairs(source: DataFrame, target: DataFrame, keys: Sequence[str] = ("order_id", "product_id")) -> DataFrame:
    """Source rows whose composite key the target lacks.

    The first key column must be present on both sides; in the others NULL equals NULL.
    """
    return rows_not_in(source, target, equal=keys[:1], null_safe=keys[1:])


def watermark(target: DataFrame, column: str) -> DataFrame:
    """The highest value stored: one row, one column, NULL for an empty target."""
    return target.agg(F.max(column).alias(column))


def after_watermark(source: DataFrame, column: str, mark: Column | date | None, when_empty: str = "none") -> DataFrame:
    """Source rows above ``mark``, a value or a scalar subquery.

    ``when_empty`` says what a NULL mark means: 'none' keeps nothing (as the plain
    comparison does), 'all' keeps every row, also those without a date.
    """
    if mark is None:
        return source if when_empty == "all" else source.filter(F.lit(False))
    if not isinstance(mark, Column):
        return source.filter(F.col(column) > moment(mark))
    if when_empty == "all":
        return source.filter((F.col(column) > mark) | mark.isNull())
    return source.filter(F.col(column) > mark)


def late_or_after(
    source: DataFrame, target: DataFrame, column: str, mark: date, days: int, keys: Sequence[str]
) -> DataFrame:
    """Rows above ``mark`` plus unseen rows up to ``days`` behind it, told apart by key.

    Only the target's rows of those days take part in the comparison.
    """
    floor = F.date_sub(moment(mark).cast("date"), days)
    recent = source.filter(F.col(column) > floor)
    return rows_not_in(recent, target.filter(F.col(column) > floor), null_safe=keys)


def dated_or_unseen(source: DataFrame, target: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """Rows for a target whose rows have no date yet, so that it has no watermark: all
    dated ones, and of the undated ones those whose key the target lacks."""
    undated = source.filter(F.col(column).isNull())
    return source.filter(F.col(column).isNotNull()).unionByName(rows_not_in(undated, target, null_safe=keys))


#: Ids up to which a target is asked for them one by one.
FEW_IDS = 10_000


def within_range(target: DataFrame, source: DataFrame, key: str, few: int = FEW_IDS) -> DataFrame:
    """The target's rows whose key can be one of the source's: those between its lowest and its
    highest, and if it has few, those equal to one. No others can match.

    Where files are in the order of the key the range skips most of them. Few ids from all over
    the range, as late rows have, go to the scan as they are: it looks them up in the Bloom
    filter of each row group, and reads the groups that may hold one.
    """
    counted = source.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.approx_count_distinct(key).alias("n"))
    ends = counted.first()
    found = target.filter(F.col(key).between(ends["low"], ends["high"]))
    if not 0 < ends["n"] <= few:
        return found
    ids = source.select(key).dropna().distinct()
    return found.filter(F.col(key).isin([row[0] for row in ids.collect()]))


def dated_snapshot(rows: DataFrame, day: date, column: str = "dt_stock") -> DataFrame:
    """All rows, stamped with the load day."""
    return rows.withColumn(column, F.lit(day))
