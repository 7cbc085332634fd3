"""Anti joins. Whether a side is broadcast is left to the planner's size check."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_not_in(
    source: DataFrame,
    target: DataFrame,
    equal: Sequence[str] = (),
    null_safe: Sequence[str] = (),
) -> DataFrame:
    """Source rows whose key has no equal in ``target``.

    ``equal`` columns match with ``=`` (a NULL never matches), ``null_safe`` ones with
    ``<=>``. Keys of different types are compared in the type that holds both, so 1 and
    1.0 are one key, and 1 and 1.5 are two.

    Only the distinct keys of the target are shuffled, so a key that fills a third of
    the target is reduced to one row per task first. The key hash in the condition
    gives both sides a plain shuffle of their own, the form whose hot source
    partitions AQE can split (the distinct alone would leave its own behind).
    """
    keys = [*equal, *null_safe]
    common = source.select(*keys).limit(0).unionByName(target.select(*keys).limit(0)).schema
    own = {key: F.col(key).cast(common[key].dataType) for key in keys}
    known = target.select(*[own[key].alias(f"_known_{key}") for key in keys]).distinct()
    matches = [own[key] == F.col(f"_known_{key}") for key in equal]
    matches += [own[key].eqNullSafe(F.col(f"_known_{key}")) for key in null_safe]
    matches.append(F.xxhash64(*own.values()) == F.xxhash64(*[f"_known_{key}" for key in keys]))
    return source.join(known, reduce(and_, matches), "left_anti")


def not_in(candidates: DataFrame, existing: DataFrame, key: str, null_aware: bool = True) -> DataFrame:
    """Candidates whose ``key`` is not in ``existing``.

    ``null_aware`` keeps what ``key NOT IN (SELECT key ...)`` means: a NULL among the
    existing keys rejects everything, a NULL candidate passes only when there are no
    existing keys at all. It is written as an anti join plus two scalars because the
    built-in form always broadcasts the existing keys, however many there are.
    Otherwise NULL is a key like any other.
    """
    if not null_aware:
        return rows_not_in(candidates, existing, null_safe=[key])
    total = existing.agg(F.count("*").alias("n")).scalar()
    nulls = existing.agg(F.count_if(F.col(key).isNull()).alias("n")).scalar()
    unmatched = rows_not_in(candidates, existing, equal=[key])
    return unmatched.filter((nulls == 0) & (F.col(key).isNotNull() | (total == 0)))
