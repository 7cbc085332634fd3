"""Dense surrogate keys without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlift.operators.staging import stage

# monotonically_increasing_id puts the partition above bit 33 and the row below it.
_ROW_BITS = 33


def dense_keys(
    rows: DataFrame,
    name: str,
    order: Sequence[str],
    after: Column | int = 0,
    folder: str | None = None,
    within: str | None = None,
) -> DataFrame:
    """``rows`` with ``name`` = ``after`` + their position (1, 2, ...) in ``order``.

    Same keys as ``row_number() OVER (ORDER BY order NULLS LAST)``, which would sort
    everything in one task. Here the rows are range-partitioned and sorted in their
    partitions, staged once with their place in the partition (a second evaluation
    could draw other range bounds), and shifted by the sizes of the partitions before.

    Give an ``order`` that leaves no ties: it makes the keys repeatable and lets one id
    with very many rows spread over several partitions.

    ``within`` names an integer column of a few values, each of which is numbered from 1 on
    its own, as with PARTITION BY: one sort serves them all, and a value with most of the
    rows has most of the partitions.
    """
    ascending = [F.col(column).asc_nulls_last() for column in ([within] if within else []) + list(order)]
    placed = (
        rows.repartitionByRange(*ascending)
        .sortWithinPartitions(*ascending)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = stage(placed, f"keys-{name}", folder)

    # One row per range partition, and one more for each value of ``within`` that begins
    # there. As a literal the shifts need no join, and readers see the true size of the rows.
    part = F.shiftrightunsigned("_place", _ROW_BITS)
    row = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    group = F.col(within) if within else F.lit(0)
    runs = placed.groupBy(group.alias("group"), part.alias("part")).agg(F.count("*").alias("n"), F.min(row).alias("first"))
    found = sorted(tuple(run) for run in runs.collect())
    shift = F.lit(None).cast("bigint")
    for value in {run[0] for run in found}:
        own = {run[1]: run for run in found if run[0] == value}
        before = accumulate((own[at][2] if at in own else 0 for at in range(max(own))), initial=0)
        # What is left over of the rows of another value that stand before in the partition.
        shifts = [total - (own[at][3] if at in own else 0) for at, total in enumerate(before)]
        table = F.split(F.lit(",".join(map(str, shifts))), ",").cast("array<bigint>")
        shift = F.when(group == value, F.get(table, part.cast("int"))).otherwise(shift)
    base = after if isinstance(after, Column) else F.lit(after)
    key = base + shift + row + 1
    return placed.select(key.cast("long").alias(name), *rows.columns)
