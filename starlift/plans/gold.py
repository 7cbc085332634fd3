"""Gold layer: dimensions with surrogate keys, and the facts that use them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlift.functions.expressions import date_id
from starlift.operators.joins import not_in
from starlift.operators.keys import dense_keys
from starlift.operators.staging import stage

CREATED = "data_criacao_registro"


@dataclass(frozen=True)
class Dimension:
    """A dimension: its table, keys and the attributes taken from the sales."""

    table: str
    sk: str
    key: str
    attributes: tuple[str, ...]

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.key, *self.attributes)


# The four dimensions built from the sales.
DIMENSIONS = (
    Dimension("dim_products", "product_sk", "product_id", ("product_name", "brand_name", "category_name")),
    Dimension("dim_customers", "customer_sk", "customer_id", ("customer_name",)),
    Dimension("dim_staffs", "staff_sk", "staff_id", ("staff_name",)),
    Dimension("dim_stores", "store_sk", "store_id", ("store_name",)),
)


def members(order_sales: DataFrame, dimension: Dimension) -> DataFrame:
    """The distinct members seen in the sales. A changed attribute makes a second row."""
    return order_sales.select(*dimension.columns).distinct()


def all_members(
    order_sales: DataFrame, dimensions: Sequence[Dimension] = DIMENSIONS, folder: str | None = None
) -> DataFrame:
    """The members of several dimensions from one scan and one shuffle of the sales: the
    columns of all, of which a row has those of its ``dimension`` (its place in the list).

    Grouping sets make a row for each dimension and combine equal ones before they move.
    Written, because the members are looked at more than once.
    """
    columns = list(dict.fromkeys(column for dimension in dimensions for column in dimension.columns))
    sets = [[F.col(column) for column in dimension.columns] for dimension in dimensions]
    found = order_sales.groupingSets(sets, *map(F.col, columns)).agg(F.grouping_id().alias("absent"))
    # Bits of the columns that a set lacks, the last column in the lowest bit.
    absent = [
        sum(1 << bit for bit, column in enumerate(reversed(columns)) if column not in dimension.columns)
        for dimension in dimensions
    ]
    which = F.array_position(F.array(*map(F.lit, absent)), F.col("absent").cast("int")) - 1
    return stage(found.select(which.cast("int").alias("dimension"), *columns), "members", folder)


def members_of(found: DataFrame, at: int, dimension: Dimension) -> DataFrame:
    """One dimension's rows of ``all_members``."""
    return found.filter(F.col("dimension") == at).select(*dimension.columns)


def dimension_rows(order_sales: DataFrame, dimension: Dimension, as_of: date, folder: str | None = None) -> DataFrame:
    """The whole dimension, keyed 1, 2, ... in order of the natural id.

    The attributes break ties, so ids with several names get the same keys every time.
    The members are staged first: the keys take two passes, over them and not the sales.
    """
    found = stage(members(order_sales, dimension), f"members-{dimension.table}", folder)
    keyed = dense_keys(found, dimension.sk, dimension.columns, folder=folder)
    return keyed.withColumn(CREATED, F.lit(as_of))


def all_dimensions(
    order_sales: DataFrame,
    as_of: date,
    folder: str | None = None,
    dimensions: Sequence[Dimension] = DIMENSIONS,
    found: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Dimensions by table name, all of them from one scan of the sales (or their members
    that were ``found``), one distinct and one sort, each keyed as ``dimension_rows`` does."""
    found = all_members(order_sales, dimensions, folder) if found is None else found
    columns = found.columns[1:]
    keyed = dense_keys(found, "sk", columns, folder=folder, within="dimension")
    return {
        dimension.table: keyed.filter(F.col("dimension") == at).select(
            F.col("sk").alias(dimension.sk), *dimension.columns, F.lit(as_of).alias(CREATED)
        )
        for at, dimension in enumerate(dimensions)
    }


def new_dimension_rows(
    order_sales: DataFrame,
    existing: DataFrame,
    dimension: Dimension,
    as_of: date,
    sk_mode: str = "offset",
    null_aware: bool = False,
    folder: str | None = None,
) -> DataFrame:
    """Members the stored dimension lacks, with their keys.

    'rank' numbers all current members and then drops the known ones: a new key can
    repeat a stored one. 'offset' numbers only the new ones, above the highest stored key.
    """
    if sk_mode == "rank":
        ranked = dimension_rows(order_sales, dimension, as_of, folder)
        return not_in(ranked, existing, dimension.key, null_aware)
    fresh = not_in(members(order_sales, dimension), existing, dimension.key, null_aware)
    fresh = stage(fresh, f"members-{dimension.table}", folder)
    highest = existing.agg(F.coalesce(F.max(dimension.sk), F.lit(0))).scalar()
    keyed = dense_keys(fresh, dimension.sk, dimension.columns, after=highest, folder=folder)
    return keyed.withColumn(CREATED, F.lit(as_of))


def repeated_members(dims: Mapping[str, DataFrame]) -> DataFrame:
    """Per dimension the ids that have several members (n_ids), as after a change of name, and
    how many members these have (n_members). Each sale of such an id becomes several facts."""

    def one(dimension: Dimension) -> DataFrame:
        several = dims[dimension.table].groupBy(dimension.key).agg(F.count("*").alias("n")).filter("n > 1")
        return several.agg(F.count("*").alias("n_ids"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_members")).select(
            F.lit(dimension.table).alias("dimension"), "n_ids", "n_members"
        )

    return reduce(DataFrame.unionByName, [one(dimension) for dimension in DIMENSIONS if dimension.table in dims])


def _with_key(rows: DataFrame, dimension: DataFrame, key: str, sk: str) -> DataFrame:
    """Left join of one surrogate key. The planner broadcasts the dimension when its
    stored size allows; otherwise both sides shuffle and AQE splits hot ids."""
    lookup = dimension.select(F.col(key).alias(f"_{key}"), sk)
    return rows.join(lookup, F.col(key) == F.col(f"_{key}"), "left").drop(f"_{key}")


def fact_sales(order_sales: DataFrame, dims: Mapping[str, DataFrame], dim_date: DataFrame, as_of: date) -> DataFrame:
    """The sales with surrogate keys in place of ids; unmatched keys are NULL."""
    rows = order_sales.select(
        "product_id",
        "customer_id",
        "staff_id",
        "store_id",
        "item_id",
        "order_id",
        "order_date",
        "quantity",
        "list_price",
        "discount",
        date_id("order_date").alias("date_id"),
    )
    rows = _with_key(rows, dim_date, "date_id", "date_sk")
    # Smallest dimensions first, so that a shuffle for a large one carries fewer columns.
    for dimension in reversed(DIMENSIONS):
        rows = _with_key(rows, dims[dimension.table], dimension.key, dimension.sk).drop(dimension.key)
    return rows.select(
        "product_sk",
        "customer_sk",
        "staff_sk",
        "store_sk",
        "date_sk",
        "item_id",
        "order_id",
        "order_date",
        "quantity",
        "list_price",
        "discount",
        F.lit(as_of).alias(CREATED),
    )


def fact_stocks(snapshot: DataFrame, dims: Mapping[str, DataFrame], dim_date: DataFrame, as_of: date) -> DataFrame:
    """The dated stock rows with surrogate keys in place of ids."""
    rows = snapshot.select("product_id", "store_id", "quantity", date_id("dt_stock").alias("date_id"))
    rows = _with_key(rows, dim_date, "date_id", "date_sk")
    rows = _with_key(rows, dims["dim_stores"], "store_id", "store_sk")
    rows = _with_key(rows, dims["dim_products"], "product_id", "product_sk")
    return rows.select("product_sk", "store_sk", "date_sk", "quantity", F.lit(as_of).alias(CREATED))


def stock_watermark(stocks: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The latest day in the stock fact, found through its calendar key.

    The distinct keys are few (days), so the join runs on those and not on the rows.
    """
    days = stocks.select("date_sk").distinct()
    return days.join(dim_date.select("date_sk", "date"), "date_sk", "left").agg(
        F.max(F.col("date").cast("date")).alias("date")
    )
