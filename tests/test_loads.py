import os
import shutil
from dataclasses import replace
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starlift import Lake, LakeConfig
from starlift.sources import loads
from starlift.sources.loads import APPENDS, REPLACES_PARTITIONS, REPLACES_TABLE, Load, outdated, shown

ANY = ("",)


@pytest.fixture
def lake(spark, tmp_path):
    made = Lake(spark, LakeConfig(root=str(tmp_path / "lake"), prefix=f"loads{os.path.basename(tmp_path)}_".replace("-", "_")))
    yield made
    made.drop()


def elsewhere(lake):
    """The lake as another process opens it, with a catalog that has none of its tables."""
    return Lake(lake.spark, replace(lake.config, prefix=f"other_{lake.config.prefix}"))


def numbers(lake, *table):
    return sorted(row[0] for row in lake.read(*table).select("brand_id").collect())


def brands(spark, *ids):
    return spark.createDataFrame([(i, f"b{i}") for i in ids], "brand_id long, brand_name string")


def dying(spark, ids, after):
    """Rows whose computation fails in one task, when others have written theirs."""
    there = F.when(F.col("id") < after, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long"))
    return spark.range(0, ids, numPartitions=4).select(there.alias("brand_id"), F.lit("x").alias("brand_name"))


def half_written(lake, layer, table, number):
    """What a job leaves that dies while its files are moved into place: files, no mark."""
    place = lake.place(layer, table).removeprefix("file:")
    last = max(name for name in os.listdir(place) if os.path.exists(f"{place}/{name}/_SUCCESS"))
    shutil.copytree(f"{place}/{last}", f"{place}/load_id={number}")
    os.remove(f"{place}/load_id={number}/_SUCCESS")


def test_what_a_table_is_made_of():
    history = {1: Load(APPENDS, ("a", "b")), 2: Load(APPENDS, ("b",)), 4: Load(REPLACES_PARTITIONS, ("b", "c"))}
    assert shown({}) == [] and outdated({}) == []
    assert shown(history) == [(1, "a"), (4, "b"), (4, "c")]
    assert outdated(history) == []  # the state before the last load is kept
    history[5] = Load(APPENDS, ("b",))
    assert shown(history) == [(1, "a"), (4, "b"), (4, "c"), (5, "b")]
    assert outdated(history) == [(2, None), (1, "b")]
    history[6] = Load(REPLACES_TABLE, ())
    assert shown(history) == []
    history[7] = Load(APPENDS, ("z",))
    assert shown(history) == [(7, "z")] and outdated(history) == [(1, None), (2, None), (4, None), (5, None)]


def test_an_overwrite_that_dies_leaves_the_rows(spark, lake):
    lake.overwrite(brands(spark, 1, 2), "bronze", "brands")
    with pytest.raises(Exception, match="lost"):
        lake.overwrite(dying(spark, 400, 350), "bronze", "brands")
    assert numbers(lake, "bronze", "brands") == [1, 2]
    half_written(lake, "bronze", "brands", 7)
    for reader in (lake, elsewhere(lake)):
        assert numbers(reader, "bronze", "brands") == [1, 2]
        assert reader.spark.table(reader.name("bronze", "brands")).count() == 2
    lake.overwrite(brands(spark, 3), "bronze", "brands")
    for reader in (lake, elsewhere(lake)):
        assert numbers(reader, "bronze", "brands") == [3]
    left = [name for name in os.listdir(lake.place("bronze", "brands")) if name.startswith("load_id=")]
    assert "load_id=7" not in left and len(left) == 2  # the rows and those before them


def test_rows_can_come_from_the_table_that_they_replace(spark, lake):
    lake.append(brands(spark, 1, 2), "bronze", "brands")
    lake.overwrite(lake.read("bronze", "brands").filter("brand_id > 1"), "bronze", "brands")
    assert numbers(lake, "bronze", "brands") == [2]


def test_a_reader_that_has_begun_goes_on(spark, lake):
    lake.overwrite(brands(spark, *range(8)).repartition(4), "bronze", "brands")
    begun = lake.read("bronze", "brands").toLocalIterator()
    found = [next(begun)[0]]
    lake.overwrite(brands(spark, 9), "bronze", "brands")
    assert sorted(found + [row[0] for row in begun]) == list(range(8))


def test_an_append_that_dies_is_made_good_by_the_next(spark, lake):
    lake.append(brands(spark, 1), "bronze", "brands")
    with pytest.raises(Exception, match="lost"):
        lake.append_new(dying(spark, 400, 350), "bronze", "brands")
    half_written(lake, "bronze", "brands", 5)
    assert numbers(lake, "bronze", "brands") == numbers(elsewhere(lake), "bronze", "brands") == [1]
    assert lake.append_new(brands(spark, 2, 3), "bronze", "brands") == 2
    assert numbers(lake, "bronze", "brands") == numbers(elsewhere(lake), "bronze", "brands") == [1, 2, 3]


def test_the_watermark_does_not_pass_rows_of_a_broken_append(spark, lake):
    def orders(*days):
        return spark.createDataFrame([(day.day, day) for day in days], "order_id long, order_date date")

    first, second, third = date(2024, 1, 30), date(2024, 1, 31), date(2024, 2, 1)
    lake.append(orders(first), "bronze", "orders")
    lake.append(orders(second, third), "bronze", "orders")
    place = lake.place("bronze", "orders")
    os.remove(f"{place}/load_id=2/_SUCCESS")  # as if the job had died before its last act
    shutil.rmtree(f"{place}/load_id=2/order_month=202401")  # and before all files were there
    for reader in (Lake(spark, lake.config), elsewhere(lake)):
        assert reader.watermark("bronze", "orders") == first and reader.count("bronze", "orders") == 1
    again = Lake(spark, lake.config)
    again.append_new(orders(second, third), "bronze", "orders")
    assert again.watermark("bronze", "orders") == third and again.count("bronze", "orders") == 3


def test_a_day_is_replaced_whole_or_not_at_all(spark, lake):
    def stock(day, *quantities):
        return spark.createDataFrame([(1, 1, q, day) for q in quantities], "store_id long, product_id long, quantity long, dt_stock date")

    def found(reader):
        return sorted((row["dt_stock"].day, row["quantity"]) for row in reader.read("silver", "stocks_snapshot").collect())

    table = ("silver", "stocks_snapshot")
    lake.replace_partitions(stock(date(2024, 1, 1), 5, 6).unionByName(stock(date(2024, 1, 2), 7)), *table)
    lake.replace_partitions(stock(date(2024, 1, 2), 8, 9), *table)
    half_written(lake, *table, 3)
    for reader in (lake, elsewhere(lake)):
        assert found(reader) == [(1, 5), (1, 6), (2, 8), (2, 9)]
        assert rows(reader.partition_values(*table)) == [(date(2024, 1, 1),), (date(2024, 1, 2),)]
    lake.append(stock(date(2024, 1, 2), 1), *table)
    for reader in (lake, elsewhere(lake)):
        assert found(reader) == [(1, 5), (1, 6), (2, 1), (2, 8), (2, 9)]


def test_an_empty_increment_is_no_load(spark, lake):
    lake.append(brands(spark, 1), "bronze", "brands")
    assert lake.append_new(brands(spark, 2).filter("brand_id > 5"), "bronze", "brands") == 0
    # One that the optimizer finds empty, and one that only turns out to be when it runs.
    assert lake.append_new(brands(spark, 2).limit(0), "bronze", "brands") == 0
    missing = spark.range(100).selectExpr("id as brand_id").join(spark.range(5).selectExpr("id + 1000 as brand_id"), "brand_id")
    assert lake.append_new(missing.withColumn("brand_name", F.lit("x")), "bronze", "brands") == 0
    assert [name for name in os.listdir(lake.place("bronze", "brands")) if not name.startswith(".")] == ["load_id=1"]


def test_undated_rows_are_a_partition(spark, lake):
    frame = spark.createDataFrame([(1, None), (2, date(2024, 1, 1))], "order_id long, order_date date")
    lake.append(frame, "silver", "order_sales")
    for reader in (lake, elsewhere(lake)):
        assert rows(reader.read("silver", "order_sales")) == rows(frame)


def test_columns_must_be_the_stored_ones(spark, lake):
    lake.append(brands(spark, 1), "bronze", "brands")
    lake.append(brands(spark, 2).selectExpr("brand_name", "cast(brand_id as int) as brand_id"), "bronze", "brands")
    assert numbers(lake, "bronze", "brands") == [1, 2]
    with pytest.raises(ValueError, match="brand_id"):
        lake.append(brands(spark, 3).withColumnRenamed("brand_id", "id"), "bronze", "brands")
    lake.overwrite(brands(spark, 4).withColumn("extra", F.lit(1)), "bronze", "brands")  # these may change
    assert lake.read("bronze", "brands").columns == ["brand_id", "brand_name", "extra"]


def test_a_lake_in_the_warehouse(spark, tmp_path):
    lake = Lake(spark, LakeConfig(landing=str(tmp_path), prefix="warehouse_"))
    assert not lake.exists("bronze", "brands")
    lake.overwrite(brands(spark, 1), "bronze", "brands")
    lake.overwrite(brands(spark, 2), "bronze", "brands")
    assert numbers(lake, "bronze", "brands") == [2]
    place = lake.place("bronze", "brands").removeprefix("file:")
    assert os.path.isdir(place)
    lake.drop()
    assert not os.path.isdir(place) and not lake.exists("bronze", "brands")


def test_the_planner_knows_the_size_of_a_table(spark, lake):
    lake.append(brands(spark, 1), "gold", "dim_stores")
    big = spark.range(10).selectExpr("id as brand_id")
    plan = big.join(lake.read("gold", "dim_stores"), "brand_id")._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_markers_are_hidden_from_readers(spark, lake):
    lake.overwrite(brands(spark, 1), "bronze", "brands")
    names = os.listdir(lake.place("bronze", "brands") + "/load_id=1")
    assert {loads.REPLACES_TABLE, loads.ENDED} <= set(names)


def days(spark, *given):
    return spark.createDataFrame([(k, date.fromisoformat(day)) for k, day in enumerate(given)], "order_id long, order_date date")


@pytest.mark.parametrize("kind", ["parquet", "orc"])
def test_watermark_reads_footers_only(spark, lake, kind, request):
    lake = Lake(spark, replace(lake.config, table_format=kind))
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    spark.conf.set("fs.store.key", "of this session")
    request.addfinalizer(lambda: spark.conf.unset("fs.store.key"))
    lake.append(days(spark, "2024-01-31", "2024-02-03", "2024-02-09").repartition(3), "silver", "order_sales")
    lake.append(days(spark, "2024-02-27", "2024-01-02"), "silver", "order_sales")
    assert lake.watermark("silver", "order_sales") == elsewhere(lake).watermark("silver", "order_sales") == date(2024, 2, 27)
    found = lake._greatest("silver", "order_sales", 202402)
    assert found._jdf.queryExecution().toString().count("PushedAggregation: [MAX(order_date)]") >= 2
    assert lake._footer_session().conf.get("fs.store.key") == "of this session"
    # Only files of the month, of both loads.
    assert {path.split("order_month=")[1][:6] for path in found.inputFiles()} == {"202402"}
    assert sorted(row["mark"].day for row in found.collect()) == [9, 27]
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    # What an overwrite has replaced no longer counts, nor what a broken append left.
    # Its files have another order of columns than the load after it.
    lake.overwrite(days(spark, "2024-02-05").select("order_date", "order_id"), "silver", "order_sales")
    lake.append(days(spark, "2024-02-04"), "silver", "order_sales")
    assert lake.watermark("silver", "order_sales") == date(2024, 2, 5)


def test_watermark_of_undated_and_empty_tables(spark, lake):
    undated = spark.createDataFrame([(1, None)], "order_id long, order_date date")
    lake.append(undated, "silver", "order_sales")
    assert lake.watermark("silver", "order_sales") is None
    lake.append(days(spark, "2023-12-31"), "silver", "order_sales")
    assert lake.watermark("silver", "order_sales") == date(2023, 12, 31)
