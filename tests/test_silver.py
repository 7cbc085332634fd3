from datetime import date
from statistics import median

from conftest import final_plan, rows
from pyspark.sql import functions as F

from starlift import Lake, LakeConfig
from starlift.operators import after_watermark, new_folder, stage
from starlift.plans.silver import ORDER_SALES_COLUMNS, order_sales
from starlift.queries.binding import CUTOFF, Entities


def frames(spark):
    return {
        "order_items": spark.createDataFrame(
            [(1, 1, 10, 2, 9.5, 0.1), (1, 2, 11, 1, 8.0, 0.0), (2, 1, 99, 1, 7.0, 0.0), (3, 1, None, 1, 6.0, 0.0)],
            "order_id long, item_id long, product_id long, quantity long, list_price double, discount double",
        ),
        "orders": spark.createDataFrame(
            [(1, 5, 1, 1, date(2020, 1, 2)), (2, 6, 9, None, date(2020, 1, 3))],
            "order_id long, customer_id long, staff_id long, store_id long, order_date date",
        ),
        "products": spark.createDataFrame(
            [(10, "Bike", 1, 1, 1000.0), (11, "Fork", 2, 7, 20.0)],
            "product_id long, product_name string, brand_id long, category_id long, list_price double",
        ),
        "brands": spark.createDataFrame([(1, "Acme")], "brand_id long, brand_name string"),
        "categories": spark.createDataFrame([(1, "Road")], "category_id long, category_name string"),
        "customers": spark.createDataFrame(
            [(5, "Ann", "Lee"), (6, "Bo", None)], "customer_id long, first_name string, last_name string"
        ),
        "staffs": spark.createDataFrame([(1, "Sue", "Fox")], "staff_id long, first_name string, last_name string"),
        "stores": spark.createDataFrame([(1, "North")], "store_id long, store_name string"),
    }


def test_unmatched_parts_are_null_and_the_price_is_the_lines(spark):
    sales = order_sales(**frames(spark))
    assert tuple(sales.columns) == ORDER_SALES_COLUMNS
    first, second = date(2020, 1, 2), date(2020, 1, 3)
    assert rows(sales) == sorted(
        [
            (10, "Bike", "Acme", "Road", 5, "Ann Lee", 1, "Sue Fox", 1, "North", 1, 1, first, 2, 9.5, 0.1),
            (11, "Fork", None, None, 5, "Ann Lee", 1, "Sue Fox", 1, "North", 1, 2, first, 1, 8.0, 0.0),
            (None, None, None, None, 6, None, None, None, None, None, 2, 1, second, 1, 7.0, 0.0),
            (None, None, None, None, None, None, None, None, None, None, 3, 1, None, 1, 6.0, 0.0),
        ],
        key=repr,
    )


def test_duplicate_lookups_fan_out_as_the_plain_join_chain_does(spark):
    tables = frames(spark)
    for name in ("orders", "products", "brands", "customers", "stores"):
        tables[name] = tables[name].unionByName(tables[name])
    for name, frame in tables.items():
        frame.createOrReplaceTempView(f"dup_{name}")
    chain = spark.sql("""
        SELECT p.product_id, b.brand_name, c.customer_id, t.store_id, i.order_id, i.item_id
        FROM dup_order_items i
        LEFT JOIN dup_orders o ON i.order_id = o.order_id
        LEFT JOIN dup_products p ON p.product_id = i.product_id
        LEFT JOIN dup_brands b ON p.brand_id = b.brand_id
        LEFT JOIN dup_categories k ON p.category_id = k.category_id
        LEFT JOIN dup_customers c ON o.customer_id = c.customer_id
        LEFT JOIN dup_staffs s ON o.staff_id = s.staff_id
        LEFT JOIN dup_stores t ON t.store_id = o.store_id""")
    assert rows(order_sales(**tables).select(*chain.columns)) == rows(chain)


def test_the_increment_filters_orders_at_the_scan(spark, sf_dir):
    sales = after_watermark(Entities(spark, sf_dir).order_sales(), "order_date", CUTOFF)
    plan = sales._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderdate,1999-12-31T00:00)" in plan
    assert "[order_id#" in plan and "Inner" in plan  # no line without a new order is carried on


def test_columns_no_one_asks_for_are_not_read(spark, sf_dir):
    plan = Entities(spark, sf_dir).order_sales()._jdf.queryExecution().executedPlan().toString()
    for unread in ("l_tax", "l_shipdate", "o_totalprice", "p_size", "p_retailprice", "c_acctbal"):
        assert unread not in plan


def test_a_hot_order_and_a_hot_product_are_split(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
    )
    hot = F.col("id") % 3 > 0
    tables = frames(spark)
    tables["order_items"] = spark.range(0, 60_000, 1, 12).select(
        F.when(hot, F.lit(1)).otherwise(F.col("id")).alias("order_id"),
        F.col("id").alias("item_id"),
        F.when(hot, F.lit(10)).otherwise(F.col("id") % 1000).alias("product_id"),
        (F.xxhash64("id") % 1000).alias("quantity"),
        F.rand(1).alias("list_price"),
        F.rand(2).alias("discount"),
    )
    tables["orders"] = stage(
        spark.range(60_000).select(
            F.col("id").alias("order_id"),
            (F.col("id") % 7).alias("customer_id"),
            F.col("id").alias("staff_id"),
            F.col("id").alias("store_id"),
            F.lit(date(2020, 1, 2)).alias("order_date"),
        ),
        "orders",
    )
    sales = order_sales(**tables)
    found = sales.agg(F.count("*"), F.sum("quantity"), F.count("brand_name"), F.count("order_date"))
    expected = tables["order_items"].agg(
        F.count("*"), F.sum("quantity"), F.count_if(F.col("product_id") == 10), F.count("*")
    )
    assert rows(found) == rows(expected)
    assert final_plan(found).count("skew=true") >= 2


def test_a_hot_month_is_written_by_several_tasks(spark, settings):
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB")
    lake = Lake(spark, LakeConfig(root=new_folder(spark, "hot"), prefix="hotmonth_"))
    lake.create_databases()
    orders = spark.range(0, 60_000, 1, 12).select(
        F.col("id").alias("order_id"),
        F.xxhash64("id").alias("customer_id"),
        F.when(F.col("id") % 3 > 0, F.lit(date(2020, 1, 5)))
        .otherwise(F.date_add(F.lit(date(2020, 2, 1)), (F.col("id") % 300).cast("int")))
        .alias("order_date"),
    )
    lake.append(orders, "bronze", "orders")
    stored = spark.table(lake.name("bronze", "orders"))
    written = stored.select("order_month", F.input_file_name().alias("file")).distinct()
    files = dict(written.groupBy("order_month").count().collect())
    # A small month shares the hot one's fate only where both hash to one partition.
    assert files[202001] > 3
    assert median(count for month, count in files.items() if month != 202001) == 1
    assert lake.count("bronze", "orders") == 60_000
    assert lake.read("bronze", "orders").columns == ["order_id", "customer_id", "order_date"]
    lake.drop()


def test_products_first_gives_the_same_rows(spark):
    tables = frames(spark)
    for name in ("orders", "products", "customers"):
        tables[name] = tables[name].unionByName(tables[name])
    tables["order_items"] = tables["order_items"].unionByName(tables["order_items"].withColumn("order_id", F.lit(None).cast("long")))
    assert rows(order_sales(**tables, products_first=True)) == rows(order_sales(**tables))
