"""The sales star as its readers get it: one view, of which a query pays for what it uses.

Every dimension is joined on the left, as one row for each key. The optimizer knows that such a
join neither adds nor drops sales, so a dimension none of whose columns are asked for leaves the
plan. The calendar is joined by day and month: with a condition on it the join is an inner one,
and the months it finds are the partitions of the fact that are read.
"""

from __future__ import annotations

from starlift.plans.gold import DIMENSIONS
from starlift.sources.loads import COLUMN
from starlift.sources.tables import Lake

VIEW = "sales"

# What the view takes from the fact and from the calendar.
MEASURES = ("order_id", "item_id", "order_date", "quantity", "list_price", "discount")
PARTS_OF_DATE = ("year", "month", "day")


def _rows(lake: Lake, table: str) -> str:
    """A gold table by name. The condition, always true, lets the planner know its size."""
    name = lake.name("gold", table)
    return f"(SELECT * FROM {name} WHERE {COLUMN} > 0)" if COLUMN in lake.spark.table(name).columns else name


def sales_sql(lake: Lake) -> str:
    columns, joins = [f"f.{column}" for column in MEASURES], []
    for dimension in DIMENSIONS:
        columns += [f"{dimension.sk}_row.value.{column}" for column in dimension.columns]
        joins.append(
            f"LEFT JOIN (SELECT {dimension.sk}, min(struct({', '.join(dimension.columns)})) AS value "
            f"FROM {_rows(lake, dimension.table)} GROUP BY {dimension.sk}) {dimension.sk}_row "
            f"ON f.{dimension.sk} = {dimension.sk}_row.{dimension.sk}"
        )
    columns += [f"d.{column}" for column in PARTS_OF_DATE]
    parts = ", ".join(f"min({column}) AS {column}" for column in PARTS_OF_DATE)
    joins.append(
        f"LEFT JOIN (SELECT date_sk, min(CAST(year * 100 + month AS INT)) AS of_month, {parts} "
        f"FROM {_rows(lake, 'dim_date')} GROUP BY date_sk) d ON f.date_sk = d.date_sk AND f.order_month = d.of_month"
    )
    return f"SELECT {', '.join(columns)} FROM {_rows(lake, 'fact_sales')} f {' '.join(joins)}"


def create_view(lake: Lake) -> str:
    """Make or renew ``gold.sales`` in this session's catalog, with the tables under it; its name."""
    for table in ("fact_sales", "dim_date", *(dimension.table for dimension in DIMENSIONS)):
        if not lake.exists("gold", table):
            raise ValueError(f"gold.{table} has not been loaded")
    name = lake.name("gold", VIEW)
    lake.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sales_sql(lake)}")
    return name
