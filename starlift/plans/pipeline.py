"""The layer runs and the run from end to end."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from datetime import date, timedelta
from functools import partial

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from starlift.functions.calendar import calendar_between
from starlift.operators.policies import after_watermark, dated_or_unseen, dated_snapshot, late_or_after
from starlift.operators.staging import discard, new_folder
from starlift.operators.together import together
from starlift.plans import bronze, gold, serving, silver
from starlift.sources.landing import copy_csv, discover_csv
from starlift.sources.ledger import files_of, signature
from starlift.sources.schemas import ENTITIES
from starlift.sources.tables import Lake, observed

# The columns that identify an order line when late rows are accepted.
LINE_KEY = ("order_id", "item_id")

# Days of stock up to which a load is written where its rows are. Gathering it by
# day would move every row, to spare each task a file for each further day.
FEW_DAYS = 8


def _copy(lake: Lake, entity: str, path: str) -> None:
    config, ledger = lake.config, lake.ledger
    mark = signature(lake.spark, path, config.multiline)
    landed = files_of(lake.spark, f"{config.landing_dir}/{entity}.csv")
    if config.skip_unchanged and landed and ledger.holds("landing", entity, mark):
        return
    ledger.forget("landing", entity)
    copy_csv(lake.spark, path, config.landing_dir, entity, config.multiline)
    ledger.record("landing", entity, mark)


def run_landing(lake: Lake, source: str) -> None:
    """Publish every CSV extract of ``source`` as it is, replacing the earlier one. What has
    not changed since it was published stays."""
    found = discover_csv(lake.spark, source)
    together(lake.spark, *[partial(_copy, lake, entity, path) for entity, path in found.items()])


def _load(lake: Lake, entity: str) -> None:
    config, ledger = lake.config, lake.ledger
    rules = (config.null_marker, config.item_key, config.late_days, config.empty_watermark, config.multiline)
    mark = signature(lake.spark, f"{config.landing_dir}/{entity}.csv", *rules)
    if config.skip_unchanged and lake.exists("bronze", entity) and ledger.holds("bronze", entity, mark):
        return
    ledger.forget("bronze", entity)
    bronze.load_entity(lake, entity)
    ledger.record("bronze", entity, mark)


def run_bronze(lake: Lake) -> None:
    """Load every landed extract that has changed since it was loaded."""
    lake.create_databases()
    together(lake.spark, *[partial(_load, lake, entity) for entity in ENTITIES])


def _flat_sales(lake: Lake, above: date | None = None, products_first: bool = False) -> DataFrame:
    """The sales of all orders, or of those dated after ``above``.

    Of the order lines only those within the id range of such orders can match. Ids
    mostly grow with time, so the range skips the row groups of older loads.
    """
    tables = {name: lake.read("bronze", name) for name in ENTITIES if name != "stocks"}
    if above is not None:
        tables["orders"] = lake.read("bronze", "orders", above)
        ids = tables["orders"].agg(F.min("order_id").alias("low"), F.max("order_id").alias("high")).first()
        tables["order_items"] = tables["order_items"].filter(F.col("order_id").between(ids["low"], ids["high"]))
    return silver.order_sales(name_separator=lake.config.name_separator, products_first=products_first, **tables)


def _without_mark(lake: Lake, rows: DataFrame, layer: str, table: str) -> DataFrame:
    """What a target without any dated row still needs of ``rows``."""
    if lake.config.empty_watermark == "all" and not lake.is_empty(layer, table):
        return dated_or_unseen(rows, lake.read(layer, table), "order_date", LINE_KEY)
    return after_watermark(rows, "order_date", None, lake.config.empty_watermark)


def load_order_sales(lake: Lake) -> None:
    if not lake.exists("silver", "order_sales"):
        lake.append(_flat_sales(lake, products_first=True), "silver", "order_sales")
        return
    config = lake.config
    mark = lake.watermark("silver", "order_sales")
    if mark is None:
        rows = _without_mark(lake, _flat_sales(lake), "silver", "order_sales")
    elif config.late_days:
        floor = mark - timedelta(days=config.late_days)
        recent = _flat_sales(lake, above=floor)
        stored = lake.read("silver", "order_sales", above=floor)
        rows = late_or_after(recent, stored, "order_date", mark, config.late_days, LINE_KEY)
    else:
        rows = after_watermark(_flat_sales(lake, above=mark), "order_date", mark)
    lake.append_new(rows, "silver", "order_sales")


def load_stocks_snapshot(lake: Lake, as_of: date) -> None:
    rows = dated_snapshot(lake.read("bronze", "stocks"), as_of)
    write = lake.append if lake.config.snapshot_mode == "append" else lake.replace_partitions
    write(rows, "silver", "stocks_snapshot", gather=False)  # they are of one day


def run_silver(lake: Lake, as_of: date) -> None:
    lake.create_databases()
    together(lake.spark, partial(load_order_sales, lake), partial(load_stocks_snapshot, lake, as_of))


def load_dimension(
    lake: Lake, dimension: gold.Dimension, as_of: date, found: DataFrame, folder: str
) -> None:
    """Add the members of the sales (``found``) that the stored dimension lacks."""
    config = lake.config
    existing = lake.read("gold", dimension.table)
    rows = gold.new_dimension_rows(found, existing, dimension, as_of, config.sk_mode, config.null_aware, folder)
    # The rows are staged already, so looking for a first one costs next to nothing.
    if not rows.isEmpty():
        lake.append(rows, "gold", dimension.table)


def load_dimensions(lake: Lake, as_of: date, known_until: date | None, folder: str) -> None:
    """All dimensions from one scan of the sales, or two if some of them are not there yet.

    ``known_until``: sales up to that day are in the facts, so their members are stored.
    """
    stored = [dimension for dimension in gold.DIMENSIONS if lake.exists("gold", dimension.table)]
    missing = [dimension for dimension in gold.DIMENSIONS if dimension not in stored]
    tasks = []
    if missing:
        built = gold.all_dimensions(lake.read("silver", "order_sales"), as_of, folder, missing)
        tasks += [partial(lake.overwrite, rows, "gold", table) for table, rows in built.items()]
    if stored:
        sales = lake.read("silver", "order_sales", known_until if lake.config.new_sales_only else None)
        found = gold.all_members(sales, stored, folder)
        for at, dimension in enumerate(stored):
            tasks.append(partial(load_dimension, lake, dimension, as_of, gold.members_of(found, at, dimension), folder))
    together(lake.spark, *tasks)


def load_calendar(lake: Lake) -> None:
    if not lake.exists("gold", "dim_date"):
        config = lake.config
        lake.append(
            calendar_between(lake.spark, config.calendar_start, config.calendar_end).coalesce(1), "gold", "dim_date"
        )


class FanOut(UserWarning):
    """Sales that became several facts, because an id has several members in a dimension."""


def load_fact_sales(lake: Lake, as_of: date) -> None:
    """Add the new sales to the fact. They are counted on their way in and out: a difference
    is reported, with the ids of each dimension that have several members."""
    config = lake.config
    dims = {dimension.table: lake.read("gold", dimension.table) for dimension in gold.DIMENSIONS}
    dim_date = lake.read("gold", "dim_date")
    first = not lake.exists("gold", "fact_sales")
    mark = None if first else lake.watermark("gold", "fact_sales")
    if first:
        sales = lake.read("silver", "order_sales")
    elif mark is None:
        sales = _without_mark(lake, lake.read("silver", "order_sales"), "gold", "fact_sales")
    elif config.late_days:
        floor = mark - timedelta(days=config.late_days)
        recent = lake.read("silver", "order_sales", above=floor)
        stored = lake.read("gold", "fact_sales", above=floor)
        sales = late_or_after(recent, stored, "order_date", mark, config.late_days, LINE_KEY)
    else:
        sales = lake.read("silver", "order_sales", above=mark)
    seen = Observation()
    facts = gold.fact_sales(sales.observe(seen, F.count(F.lit(1)).alias("n")), dims, dim_date, as_of)
    written = (lake.overwrite if first else lake.append_new)(facts, "gold", "fact_sales")
    taken = observed(seen)
    if lake.counts_writes and taken is not None and written != taken:
        repeated = {row["dimension"]: row["n_ids"] for row in gold.repeated_members(dims).filter("n_ids > 0").collect()}
        warnings.warn(FanOut(f"{taken} sales became {written} facts; ids with several members: {repeated}"), stacklevel=2)


def load_fact_stocks(lake: Lake, as_of: date) -> None:
    """The stock fact is partitioned by day: a day loaded again replaces itself."""
    config = lake.config
    dims = {name: lake.read("gold", name) for name in ("dim_products", "dim_stores")}
    dim_date = lake.read("gold", "dim_date")
    snapshot = lake.read("silver", "stocks_snapshot")
    days = lake.partition_values("silver", "stocks_snapshot")
    if config.rebuild_stocks or not lake.exists("gold", "fato_stocks"):
        gather = days.count() > FEW_DAYS
        lake.overwrite(gold.fact_stocks(snapshot, dims, dim_date, as_of), "gold", "fato_stocks", gather)
        return
    mark = gold.stock_watermark(lake.partition_values("gold", "fato_stocks"), dim_date).first()["date"]
    if config.snapshot_mode == "replace_day" and mark is not None:
        before = mark - timedelta(days=1)
        again = lake.read("silver", "stocks_snapshot", above=before)
        gather = days.filter(F.col("dt_stock") > F.lit(before)).count() > FEW_DAYS
        lake.replace_partitions(gold.fact_stocks(again, dims, dim_date, as_of), "gold", "fato_stocks", gather)
    else:
        rows = after_watermark(snapshot, "dt_stock", mark, config.empty_watermark)
        lake.append_new(gold.fact_stocks(rows, dims, dim_date, as_of), "gold", "fato_stocks")


def run_gold(lake: Lake, as_of: date) -> None:
    """Dimensions and calendar first, then the facts that read their stored keys."""
    config = lake.config
    if not config.rebuild_stocks and not config.calendar_start <= as_of <= config.calendar_end:
        raise ValueError(f"{as_of} is outside the calendar: its stock rows would have no date key")
    lake.create_databases()
    known_until = None
    if config.new_sales_only and lake.exists("gold", "fact_sales"):
        known_until = lake.watermark("gold", "fact_sales")
        if known_until is not None and config.late_days:
            known_until -= timedelta(days=config.late_days)
    folder = new_folder(lake.spark, "gold")
    try:
        together(lake.spark, partial(load_calendar, lake), partial(load_dimensions, lake, as_of, known_until, folder))
    finally:
        discard(lake.spark, folder)
    together(lake.spark, partial(load_fact_sales, lake, as_of), partial(load_fact_stocks, lake, as_of))
    serving.create_view(lake)


# The layers in the order in which they build on each other.
STEPS = ("landing", "bronze", "silver", "gold")


def run_layers(lake: Lake, layers: Sequence[str], source: str | None, as_of: date) -> None:
    """The chosen layers in their order. Only landing needs a ``source``."""
    if "landing" in layers:
        run_landing(lake, source)
    if "bronze" in layers:
        run_bronze(lake)
    if "silver" in layers:
        run_silver(lake, as_of)
    if "gold" in layers:
        run_gold(lake, as_of)


def run_all(lake: Lake, source: str, as_of: date) -> None:
    """Landing, bronze, silver, gold. Every step can be run again after a failure."""
    run_layers(lake, STEPS, source, as_of)
