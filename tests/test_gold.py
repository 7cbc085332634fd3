from datetime import date

import pytest
from conftest import final_plan, rows
from pyspark.sql import functions as F

from starlift.functions import calendar_between
from starlift.operators import stage
from starlift.plans import gold

DAY = date(2020, 1, 31)
CUSTOMERS = gold.DIMENSIONS[1]
SALES = (
    "product_id long, product_name string, brand_name string, category_name string, customer_id long, "
    "customer_name string, staff_id long, staff_name string, store_id long, store_name string, order_id long, "
    "item_id long, order_date date, quantity long, list_price double, discount double"
)


def sale(order, customer, name=None, product=1, day=date(2020, 1, 2)):
    name = name or f"customer {customer}"
    return (product, f"p{product}", "b", "c", customer, name, 1, "s", 1, "st", order, 1, day, 2, 9.5, 0.1)


@pytest.fixture
def calendar(spark):
    return calendar_between(spark, date(2020, 1, 1), date(2020, 12, 31))


def stored_customers(spark, *pairs):
    members = [(sk, key, f"customer {key}", DAY) for sk, key in pairs]
    return spark.createDataFrame(members, "customer_sk long, customer_id long, customer_name string, x date")


def test_columns_and_types(spark):
    sales = spark.createDataFrame([sale(1, 5), sale(2, 3), sale(3, 5)], SALES)
    dims = gold.all_dimensions(sales, DAY)
    assert dims["dim_products"].dtypes == [
        ("product_sk", "bigint"),
        ("product_id", "bigint"),
        ("product_name", "string"),
        ("brand_name", "string"),
        ("category_name", "string"),
        ("data_criacao_registro", "date"),
    ]
    assert rows(dims["dim_customers"]) == [(1, 3, "customer 3", DAY), (2, 5, "customer 5", DAY)]
    assert dims["dim_staffs"].columns == ["staff_sk", "staff_id", "staff_name", "data_criacao_registro"]
    assert dims["dim_stores"].columns == ["store_sk", "store_id", "store_name", "data_criacao_registro"]


def test_rank_repeats_a_stored_key_and_offset_does_not(spark):
    sales = spark.createDataFrame([sale(order, order) for order in (1, 2, 3)], SALES)
    stored = stored_customers(spark, (1, 1), (2, 3))
    ranked = gold.new_dimension_rows(sales, stored, CUSTOMERS, DAY, "rank", null_aware=True)
    assert rows(ranked) == [(2, 2, "customer 2", DAY)]
    offset = gold.new_dimension_rows(sales, stored, CUSTOMERS, DAY, "offset")
    assert rows(offset) == [(3, 2, "customer 2", DAY)]


@pytest.mark.parametrize("mode", ["rank", "offset"])
def test_a_null_member(spark, mode):
    sales = spark.createDataFrame([sale(1, 1), sale(2, None, "?"), sale(3, 2)], SALES)
    with_null = stored_customers(spark, (1, 1), (2, None))
    strict = gold.new_dimension_rows(sales, with_null, CUSTOMERS, DAY, mode, null_aware=True)
    assert rows(strict) == []
    safe = gold.new_dimension_rows(sales, with_null, CUSTOMERS, DAY, mode, null_aware=False)
    assert [row[1] for row in rows(safe)] == [2]


def test_a_renamed_member_makes_two_rows_and_the_fact_fans_out(spark, calendar):
    sales = spark.createDataFrame([sale(1, 7, "old"), sale(2, 7, "new")], SALES)
    dims = gold.all_dimensions(sales, DAY)
    assert rows(dims["dim_customers"]) == [(1, 7, "new", DAY), (2, 7, "old", DAY)]
    assert gold.fact_sales(sales, dims, calendar, DAY).count() == 4


def test_unknown_members_and_days_have_null_keys(spark, calendar):
    known = spark.createDataFrame([sale(1, 1)], SALES)
    dims = gold.all_dimensions(known, DAY)
    sales = spark.createDataFrame(
        [sale(1, 1), sale(2, 2, product=8), sale(3, None, day=None), sale(4, 1, day=date(2031, 1, 1))], SALES
    )
    fact = gold.fact_sales(sales, dims, calendar, DAY)
    assert fact.columns == [
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
        "data_criacao_registro",
    ]
    keys = {row["order_id"]: (row["product_sk"], row["customer_sk"], row["date_sk"]) for row in fact.collect()}
    assert keys == {1: (1, 1, 2), 2: (None, None, 2), 3: (1, None, None), 4: (1, 1, None)}


def test_stocks_and_their_watermark(spark, calendar):
    dims = gold.all_dimensions(spark.createDataFrame([sale(1, 1)], SALES), DAY)
    snapshot = spark.createDataFrame(
        [(1, 1, 4, date(2020, 1, 3)), (1, 9, 5, date(2020, 1, 4)), (2, 1, 6, date(2020, 1, 4))],
        "store_id long, product_id long, quantity long, dt_stock date",
    )
    fact = gold.fact_stocks(snapshot, dims, calendar, DAY)
    assert rows(fact) == sorted([(1, 1, 3, 4, DAY), (None, 1, 4, 5, DAY), (1, None, 4, 6, DAY)], key=repr)
    assert rows(gold.stock_watermark(fact, calendar)) == [(date(2020, 1, 4),)]
    off_calendar = gold.fact_stocks(snapshot.withColumn("dt_stock", F.lit(date(2031, 1, 1))), dims, calendar, DAY)
    assert rows(gold.stock_watermark(off_calendar, calendar)) == [(None,)]


def test_a_hot_customer_is_split_when_the_dimension_is_too_large_to_broadcast(spark, settings, calendar):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
    )
    customer = F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id") % 900)
    sales = spark.range(0, 60_000, 1, 12).select(
        (F.col("id") % 40).alias("product_id"),
        customer.alias("customer_id"),
        (F.col("id") % 5).alias("staff_id"),
        (F.col("id") % 3).alias("store_id"),
        F.lit(1).cast("long").alias("item_id"),
        F.col("id").alias("order_id"),
        F.date_add(F.lit(date(2020, 1, 2)), (F.col("id") % 9).cast("int")).alias("order_date"),
        (F.xxhash64("id") % 1000).alias("quantity"),
        F.lit(1.0).alias("list_price"),
        F.lit(0.0).alias("discount"),
    )
    dims = {
        dimension.table: stage(
            spark.range(900).select(F.col("id").alias(dimension.key), (F.col("id") + 1).alias(dimension.sk)), "dim"
        )
        for dimension in gold.DIMENSIONS
    }
    fact = gold.fact_sales(sales, dims, calendar, DAY)
    found = fact.agg(F.count("*"), F.count_if(F.col("customer_sk") == 8), F.sum("customer_sk"), F.sum("quantity"))
    expected = sales.agg(
        F.count("*"), F.count_if(F.col("customer_id") == 7), F.sum(F.col("customer_id") + 1), F.sum("quantity")
    )
    assert rows(found) == rows(expected)
    assert "skew=true" in final_plan(found)


def test_four_dimensions_from_one_scan_and_one_shuffle(spark, sf_dir, monkeypatch):
    from starlift.queries.binding import Entities

    sales = gold.stage(Entities(spark, sf_dir).order_sales(), "sales")
    plans = []
    monkeypatch.setattr(gold, "stage", lambda found, *names: plans.append(found._jdf.queryExecution().executedPlan().toString()) or found)
    found = gold.all_members(sales)
    assert plans[0].count("FileScan") == 1 and plans[0].count("Exchange hashpartitioning") == 1
    for at, dimension in enumerate(gold.DIMENSIONS):
        own = gold.members_of(found, at, dimension)
        assert rows(own) == rows(gold.members(sales, dimension))
