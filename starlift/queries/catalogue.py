"""Every operator and builder as a query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlift.config import LakeConfig
from starlift.operators import (
    after_watermark,
    dated_or_unseen,
    dated_snapshot,
    late_or_after,
    merged,
    new_folder,
    not_in,
    stage,
    together,
    unseen_pairs,
    watermark,
)
from starlift.plans import gold, run_all, run_bronze, serving
from starlift.plans.pipeline import LINE_KEY
from starlift.queries.binding import AS_OF, CUTOFF, DAY_BEFORE, LATER_CATEGORY, Entities
from starlift.sources.landing import publish_csv, read_landing
from starlift.sources.schemas import ENTITIES, KEYS
from starlift.sources.tables import Lake

Query = Callable[[SparkSession, str], DataFrame]


def _lake(spark: SparkSession, label: str) -> Lake:
    """A lake of its own under the shared folder."""
    config = LakeConfig(root=new_folder(spark, label), prefix=f"{label}_{uuid.uuid4().hex[:8]}_")
    return Lake(spark, config)


def publish_all(entities: Entities, folder: str, **changed: DataFrame) -> None:
    """All nine extracts as CSV in ``folder``."""

    def one(entity: str) -> None:
        rows = changed.get(entity)
        rows = getattr(entities, entity) if rows is None else rows
        if entity == "orders":
            rows = rows.withColumn("order_date", F.col("order_date").cast("date"))
        publish_csv(rows, folder, entity)

    together(entities.spark, *[partial(one, entity) for entity in ENTITIES])


# Landing and bronze


def csv_roundtrip_products(spark: SparkSession, folder: str) -> DataFrame:
    """Products through the landing CSV, with an inch mark to be quoted in each name."""
    entities = Entities(spark, folder)
    inches = entities.table("part").select(F.col("p_partkey").alias("product_id"), "p_size")
    name = F.concat("product_name", F.lit(', "'), "p_size", F.lit('"'))
    products = entities.products.join(inches, "product_id").withColumn("product_name", name).drop("p_size")
    landing = new_folder(spark, "landing")
    publish_csv(products, landing, "products")
    return read_landing(spark, landing, "products")


def csv_null_marker_staffs(spark: SparkSession, folder: str) -> DataFrame:
    """Staffs whose manager is written as NULL: kept as text, or read as a true NULL."""
    entities = Entities(spark, folder)
    top = F.col("last_name") == "0"
    staffs = entities.staffs.withColumn("manager_id", F.when(top, F.lit("NULL")).otherwise(F.col("last_name")))
    landing = new_folder(spark, "landing")
    publish_csv(staffs, landing, "staffs")
    as_text = read_landing(spark, landing, "staffs")
    as_null = read_landing(spark, landing, "staffs", null_marker="NULL")
    return as_text.join(as_null.select("staff_id", F.col("manager_id").alias("marked_id")), "staff_id")


def _bronze_lake(spark: SparkSession, folder: str) -> Lake:
    lake = _lake(spark, "bronze_full")
    publish_all(Entities(spark, folder), lake.config.landing_dir)
    run_bronze(lake)
    return lake


def bronze_full_load(spark: SparkSession, folder: str) -> DataFrame:
    """The order lines after landing and first bronze load."""
    return _bronze_lake(spark, folder).read("bronze", "order_items")


def bronze_full_load_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each bronze table after the first load."""
    lake = _bronze_lake(spark, folder)
    return _counts(lake, [("bronze", entity) for entity in ENTITIES])


def _counts(lake: Lake, tables: list[tuple[str, str]]) -> DataFrame:
    counts = [
        lake.read(layer, table)
        .agg(F.count("*").alias("n_rows"))
        .select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "n_rows")
        for layer, table in tables
    ]
    return reduce(DataFrame.unionByName, counts)


def _stored(entities: Entities, entity: str) -> DataFrame:
    """An entity's bronze table after the earlier load, with names as they were then."""
    now = getattr(entities, entity)
    later = entities.later_stores
    if entity == "brands":
        known = now.filter(F.col("brand_name") != "Brand#13")
    elif entity == "categories":
        known = now.filter(F.col("category_name") != LATER_CATEGORY)
    elif entity == "customers":
        known = now.filter(F.col("last_name") != "HOUSEHOLD")
    elif entity == "products":
        promoted = entities.categories.filter(F.col("category_name") == LATER_CATEGORY)
        known = now.join(promoted.select("category_id"), "category_id", "left_anti")
    elif entity == "staffs":
        known = now.join(later.select(F.col("store_id").cast("string").alias("last_name")), "last_name", "left_anti")
    else:
        known = now.join(later, "store_id", "left_anti")
    name = next(column for column in now.columns if column.endswith("_name"))
    return known.select(*[F.lower(c).alias(c) if c == name else F.col(c) for c in now.columns])


def bronze_merge(spark: SparkSession, folder: str, entity: str) -> DataFrame:
    entities = Entities(spark, folder)
    return merged(getattr(entities, entity), _stored(entities, entity), KEYS[entity])


def bronze_order_items_new(spark: SparkSession, folder: str) -> DataFrame:
    entities = Entities(spark, folder)
    return unseen_pairs(entities.order_items, entities.items_loaded)


def bronze_order_items_new_by_item(spark: SparkSession, folder: str) -> DataFrame:
    """The same with order and item as the key: a second line of a product is not lost."""
    entities = Entities(spark, folder)
    return unseen_pairs(entities.order_items, entities.items_loaded, keys=LINE_KEY)


def bronze_orders_new(spark: SparkSession, folder: str) -> DataFrame:
    entities = Entities(spark, folder)
    mark = watermark(entities.orders_loaded, "order_date").scalar()
    return after_watermark(entities.orders, "order_date", mark)


def bronze_stocks_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """The stocks table after two loads: the second replaces the first."""
    stocks = Entities(spark, folder).stocks
    lake = _lake(spark, "stocks")
    lake.create_databases()
    lake.append(stocks.withColumn("quantity", F.col("quantity") + 1), "bronze", "stocks")
    lake.overwrite(stocks, "bronze", "stocks")
    return lake.read("bronze", "stocks")


# Silver


def silver_order_sales_full(spark: SparkSession, folder: str) -> DataFrame:
    return Entities(spark, folder).order_sales()


def silver_order_sales_nosep(spark: SparkSession, folder: str) -> DataFrame:
    return Entities(spark, folder).order_sales(name_separator="")


def silver_order_sales_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Sales dated after those stored. The stored ones are the lines of the orders
    loaded earlier, so their latest day is that of the orders that have lines."""
    entities = Entities(spark, folder)
    stored = entities.orders_loaded.join(entities.order_items.select("order_id"), "order_id", "left_semi")
    mark = watermark(stored, "order_date").scalar()
    return after_watermark(entities.order_sales(), "order_date", mark)


def silver_order_sales_late(spark: SparkSession, folder: str) -> DataFrame:
    """The increment with 90 days of grace: unseen lines of older orders come too.
    Stored: the lines shipped by the cutoff, of the orders loaded by then."""
    entities = Entities(spark, folder)
    stored = entities.orders_loaded.select("order_id", "order_date").join(
        entities.items_loaded.select("order_id", "item_id"), "order_id"
    )
    return late_or_after(entities.order_sales(), stored, "order_date", CUTOFF, 90, LINE_KEY)


def silver_order_sales_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """First load when only the earlier orders have landed: later lines stay, with NULLs."""
    entities = Entities(spark, folder)
    return entities.order_sales(orders=entities.orders_loaded)


def silver_undated_target(spark: SparkSession, folder: str) -> DataFrame:
    """What a target still needs that holds only undated lines: those shipped by the
    cutoff, from before any order had landed. Now the earlier orders have."""
    entities = Entities(spark, folder)
    now = entities.order_sales(orders=entities.orders_loaded)
    return dated_or_unseen(now, entities.items_loaded.select("order_id", "item_id"), "order_date", LINE_KEY)


def silver_stocks_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return dated_snapshot(Entities(spark, folder).stocks, AS_OF)


# Gold


def gold_dim(spark: SparkSession, folder: str, dimension: gold.Dimension) -> DataFrame:
    return gold.dimension_rows(Entities(spark, folder).order_sales(), dimension, AS_OF)


def gold_dim_customers_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """The dimension when some orders have not landed: the NULL member gets the last key."""
    entities = Entities(spark, folder)
    return gold.dimension_rows(entities.order_sales(orders=entities.orders_loaded), gold.DIMENSIONS[1], AS_OF)


def gold_dim_new(spark: SparkSession, folder: str, dimension: gold.Dimension, mode: str) -> DataFrame:
    """Members that joined after the earlier load, keyed by rank or above the stored keys."""
    entities = Entities(spark, folder)
    # One pass for the stored members and for those of now: of each, whether it was known.
    later = entities.later_stores.select("store_id", F.lit(True).alias("later_store"))
    known = (F.col("category_name") != LATER_CATEGORY) & F.col("later_store").isNull()
    sales = entities.order_sales().join(later, "store_id", "left")
    found = stage(sales.groupBy(*dimension.columns).agg(F.bool_or(known).alias("known")), "members")
    existing = gold.dimension_rows(found.filter("known"), dimension, DAY_BEFORE)
    return gold.new_dimension_rows(found, existing, dimension, AS_OF, mode, null_aware=mode == "rank")


def gold_dim_date(spark: SparkSession, folder: str) -> DataFrame:
    return Entities(spark, folder).dim_date


def _sales_and_dims(spark: SparkSession, folder: str) -> tuple[Entities, DataFrame, dict[str, DataFrame]]:
    """Silver sales, written once because five plans read them, and the dimensions."""
    entities = Entities(spark, folder)
    sales = stage(entities.order_sales(), "order_sales")
    return entities, sales, gold.all_dimensions(sales, AS_OF)


def gold_fact_sales(spark: SparkSession, folder: str) -> DataFrame:
    entities, sales, dims = _sales_and_dims(spark, folder)
    return gold.fact_sales(sales, dims, entities.dim_date, AS_OF)


# The stored state that the increments start from, one lake for each session and folder.
_state_lakes: dict[tuple[str, str], Lake] = {}


def _stored_state(spark: SparkSession, folder: str) -> Lake:
    """All sales in silver, the dimensions of all of them, two days of stock, and the first
    of these days in the stock fact."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _state_lakes:
        entities = Entities(spark, folder)
        lake = _lake(spark, "state")
        lake.create_databases()
        lake.append(entities.order_sales(products_first=True), "silver", "order_sales")
        for name, rows in gold.all_dimensions(lake.read("silver", "order_sales"), AS_OF).items():
            lake.overwrite(rows, "gold", name)
        lake.overwrite(entities.dim_date.coalesce(1), "gold", "dim_date")
        days = F.array(F.lit(DAY_BEFORE), F.lit(AS_OF))
        lake.append(entities.stocks.withColumn("dt_stock", F.explode(days)), "silver", "stocks_snapshot", gather=False)
        earlier = lake.read("silver", "stocks_snapshot").filter(F.col("dt_stock") <= F.lit(DAY_BEFORE))
        dims = {name: lake.read("gold", name) for name in ("dim_products", "dim_stores")}
        facts = gold.fact_stocks(earlier, dims, lake.read("gold", "dim_date"), DAY_BEFORE)
        lake.append(facts, "gold", "fato_stocks", gather=False)
        _state_lakes[key] = lake
    return _state_lakes[key]


def gold_fact_sales_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """The sales after the watermark, from the stored tables: what was loaded before is
    not read again, but for the latest day among it."""
    lake = _stored_state(spark, folder)
    sales = lake.read("silver", "order_sales")
    mark = watermark(sales.filter(F.col("order_date") <= F.lit(CUTOFF)), "order_date").first()["order_date"]
    dims = {dimension.table: lake.read("gold", dimension.table) for dimension in gold.DIMENSIONS}
    recent = lake.read("silver", "order_sales", above=mark.date())
    return gold.fact_sales(recent, dims, lake.read("gold", "dim_date"), AS_OF)


def gold_fact_sales_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """All sales against dimensions that lack the later members: their keys are NULL."""
    entities = Entities(spark, folder)
    sales = stage(entities.order_sales(), "order_sales")
    dims = gold.all_dimensions(entities.earlier_sales(sales), AS_OF)
    return gold.fact_sales(sales, dims, entities.dim_date, AS_OF)


def gold_fact_sales_renamed(spark: SparkSession, folder: str) -> DataFrame:
    """Customers had other names before the cutoff: two members per id, and the fact
    has a row for each."""
    entities = Entities(spark, folder)
    name = F.when(F.col("order_date") <= F.lit(CUTOFF), F.lower("customer_name")).otherwise(F.col("customer_name"))
    sales = stage(entities.order_sales().withColumn("customer_name", name), "order_sales")
    return gold.fact_sales(sales, gold.all_dimensions(sales, AS_OF), entities.dim_date, AS_OF)


def _stock_dims(sales: DataFrame) -> dict[str, DataFrame]:
    wanted = [dimension for dimension in gold.DIMENSIONS if dimension.table in ("dim_products", "dim_stores")]
    return gold.all_dimensions(sales, AS_OF, dimensions=wanted)


def gold_fact_stocks(spark: SparkSession, folder: str) -> DataFrame:
    entities = Entities(spark, folder)
    snapshot = stage(dated_snapshot(entities.stocks, AS_OF), "snapshot")
    return gold.fact_stocks(snapshot, _stock_dims(entities.order_sales()), entities.dim_date, AS_OF)


def gold_fact_stocks_unsold(spark: SparkSession, folder: str) -> DataFrame:
    """Stocks of products and stores that the dimensions do not know."""
    entities = Entities(spark, folder)
    snapshot = stage(dated_snapshot(entities.stocks, AS_OF), "snapshot")
    dims = _stock_dims(entities.earlier_sales(entities.order_sales()))
    return gold.fact_stocks(snapshot, dims, entities.dim_date, AS_OF)


def gold_fact_stocks_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Two stored snapshots, the first already in the fact: the calendar tells which is new."""
    lake = _stored_state(spark, folder)
    dim_date = lake.read("gold", "dim_date")
    mark = gold.stock_watermark(lake.partition_values("gold", "fato_stocks"), dim_date).first()["date"]
    dims = {name: lake.read("gold", name) for name in ("dim_products", "dim_stores")}
    recent = lake.read("silver", "stocks_snapshot", above=mark)
    return gold.fact_stocks(recent, dims, dim_date, AS_OF)


def serve_gold_table(spark: SparkSession, folder: str) -> DataFrame:
    """dim_products as a reader of the gold layer gets it."""
    lake = _lake(spark, "serve")
    lake.create_databases()
    lake.overwrite(gold_dim(spark, folder, gold.DIMENSIONS[0]), "gold", "dim_products")
    return lake.read("gold", "dim_products")


def gold_repeated_members(spark: SparkSession, folder: str) -> DataFrame:
    """Ids with several members when customers had other names before the cutoff."""
    name = F.when(F.col("order_date") <= F.lit(CUTOFF), F.lower("customer_name")).otherwise(F.col("customer_name"))
    sales = Entities(spark, folder).order_sales().withColumn("customer_name", name)
    return gold.repeated_members(gold.all_dimensions(sales, AS_OF))


# Edge cases and whole runs


def incremental_empty_target(spark: SparkSession, folder: str) -> DataFrame:
    """Orders taken when the target is empty: none by the strict rule, all by the other."""
    orders = Entities(spark, folder).orders
    mark = watermark(orders.filter(F.lit(False)), "order_date").scalar()
    strict = after_watermark(orders, "order_date", mark).agg(F.count("*").alias("n"))
    every = after_watermark(orders, "order_date", mark, when_empty="all").agg(F.count("*").alias("n"))
    return strict.select(F.lit("none").alias("rule"), F.col("n").alias("n_rows")).unionByName(
        every.select(F.lit("all").alias("rule"), F.col("n").alias("n_rows"))
    )


def not_in_null_member(spark: SparkSession, folder: str) -> DataFrame:
    """New customers when the dimension holds a NULL member (lines whose orders had not
    landed): none by NOT IN, the true ones when NULL counts as a key."""
    entities = Entities(spark, folder)
    dimension = gold.DIMENSIONS[1]
    early = entities.orders.filter(F.col("order_date") < F.add_months(F.lit(CUTOFF), -54))
    stored = stage(gold.members(entities.order_sales(orders=early), dimension), "members")
    now = gold.members(entities.order_sales(), dimension)
    counts = [
        not_in(now, stored, dimension.key, null_aware)
        .agg(F.count("*").alias("n_rows"))
        .select(F.lit(null_aware).cast("string").alias("null_aware"), "n_rows")
        for null_aware in (True, False)
    ]
    return counts[0].unionByName(counts[1])


def table_exists_and_count(spark: SparkSession, folder: str) -> DataFrame:
    """Probe, first write, probe, count, preview and emptiness of a stored table."""
    entities = Entities(spark, folder)
    lake = _lake(spark, "probe")
    lake.create_databases()
    before = lake.exists("bronze", "orders")
    lake.append(entities.orders, "bronze", "orders")
    nothing_new = after_watermark(entities.orders, "order_date", lake.watermark("bronze", "orders"))
    return lake.read("bronze", "orders").agg(F.count("*").alias("n_rows")).select(
        F.lit(before).cast("string").alias("existed"),
        F.lit(lake.exists("bronze", "orders")).cast("string").alias("exists_now"),
        "n_rows",
        F.lit(lake.preview("bronze", "orders").count()).cast("long").alias("n_preview"),
        F.lit(nothing_new.isEmpty()).cast("string").alias("up_to_date"),
    )


def _two_runs(spark: SparkSession, folder: str, parity: bool) -> Lake:
    """The whole pipeline on the earlier extract, then on the full one, then once more
    on the same day. The calendar is that of the orders."""
    entities = Entities(spark, folder)
    lake = _lake(spark, "parity" if parity else "pipeline")
    years = entities.dim_date.agg(F.min("date").cast("date"), F.max("date").cast("date")).first()
    config = replace(lake.config, calendar_start=years[0], calendar_end=years[1])
    lake = Lake(spark, config.parity() if parity else config)
    early = entities.orders_loaded
    early_items = entities.order_items.join(early.select("order_id"), "order_id", "left_semi")
    first, second = new_folder(spark, "extract"), new_folder(spark, "extract")
    stocks = stage(entities.stocks, "stocks")  # the same in both extracts
    together(
        spark,
        partial(publish_all, entities, first, orders=early, order_items=early_items, stocks=stocks),
        partial(publish_all, entities, second, stocks=stocks),
    )
    run_all(lake, first, DAY_BEFORE)
    run_all(lake, second, AS_OF)
    run_all(lake, second, AS_OF)
    return lake


def _run_counts(lake: Lake) -> DataFrame:
    tables = [("bronze", entity) for entity in ENTITIES]
    tables += [("silver", "order_sales"), ("silver", "stocks_snapshot")]
    tables += [("gold", dimension.table) for dimension in gold.DIMENSIONS]
    tables += [("gold", "dim_date"), ("gold", "fact_sales"), ("gold", "fato_stocks")]
    return _counts(lake, tables)


# Tables whose content after the runs is a query.
STORED = (
    ("bronze", "orders"),
    ("silver", "order_sales"),
    ("silver", "stocks_snapshot"),
    *(("gold", dimension.table) for dimension in gold.DIMENSIONS),
    ("gold", "fact_sales"),
    ("gold", "fato_stocks"),
)

# The lake of the default rules, one for each session and folder: several queries read it.
_run_lakes: dict[tuple[str, str], Lake] = {}


def pipeline_two_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every table after the runs."""
    lake = _two_runs(spark, folder, parity=False)
    _run_lakes[(spark.sparkContext.applicationId, folder)] = lake
    return _run_counts(lake)


def pipeline_two_runs_parity(spark: SparkSession, folder: str) -> DataFrame:
    return _run_counts(_two_runs(spark, folder, parity=True))


def _run_lake(spark: SparkSession, folder: str) -> Lake:
    """The lake after the runs, opened anew."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _run_lakes:
        _run_lakes[key] = _two_runs(spark, folder, parity=False)
    return Lake(spark, _run_lakes[key].config)


def pipeline_table(spark: SparkSession, folder: str, layer: str, table: str) -> DataFrame:
    """A table as a reader gets it after the runs."""
    return _run_lake(spark, folder).read(layer, table)


def serve_sales_by_category(spark: SparkSession, folder: str) -> DataFrame:
    """Two years of sales by category, from the view over the fact and all dimensions: two
    of the five are joined, and the months of the two years are read."""
    name = serving.create_view(_run_lake(spark, folder))
    return spark.sql(
        f"""SELECT year, category_name, count(*) AS n_lines, sum(quantity) AS quantity
            FROM {name} WHERE year BETWEEN 1997 AND 1998 GROUP BY year, category_name"""
    )


def serve_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Every sale with all attributes, from the view."""
    return spark.table(serving.create_view(_run_lake(spark, folder)))


def catalogue() -> dict[str, Query]:
    queries: dict[str, Query] = {
        "csv_roundtrip_products": csv_roundtrip_products,
        "csv_null_marker_staffs": csv_null_marker_staffs,
        "bronze_full_load": bronze_full_load,
        "bronze_full_load_counts": bronze_full_load_counts,
    }
    for entity in KEYS:
        queries[f"bronze_merge_{entity}"] = partial(bronze_merge, entity=entity)
    for layer, table in STORED:
        queries[f"stored_{table}"] = partial(pipeline_table, layer=layer, table=table)
    for query in (
        bronze_order_items_new,
        bronze_order_items_new_by_item,
        bronze_orders_new,
        bronze_stocks_refresh,
        silver_order_sales_full,
        silver_order_sales_nosep,
        silver_order_sales_incremental,
        silver_order_sales_late,
        silver_order_sales_orphans,
        silver_undated_target,
        silver_stocks_snapshot,
    ):
        queries[query.__name__] = query
    for dimension in gold.DIMENSIONS:
        queries[f"gold_{dimension.table}"] = partial(gold_dim, dimension=dimension)
        for mode in ("rank", "offset"):
            queries[f"gold_{dimension.table}_new_{mode}"] = partial(gold_dim_new, dimension=dimension, mode=mode)
    for query in (
        gold_dim_customers_orphans,
        gold_dim_date,
        gold_fact_sales,
        gold_fact_sales_incremental,
        gold_fact_sales_orphans,
        gold_fact_sales_renamed,
        gold_fact_stocks,
        gold_fact_stocks_unsold,
        gold_fact_stocks_incremental,
        gold_repeated_members,
        serve_gold_table,
        serve_sales_by_category,
        serve_sales,
        incremental_empty_target,
        not_in_null_member,
        table_exists_and_count,
        pipeline_two_runs,
        pipeline_two_runs_parity,
    ):
        queries[query.__name__] = query
    return queries
