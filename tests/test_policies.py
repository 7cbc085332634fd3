from datetime import date, datetime

import pytest
from conftest import rows

from starlift import Lake, LakeConfig
from starlift.operators import after_watermark, dated_snapshot, late_or_after, watermark, within_range

ORDERS = "order_id long, order_date date"


@pytest.fixture
def orders(spark):
    return spark.createDataFrame(
        [(1, date(2020, 1, 1)), (2, date(2020, 1, 5)), (3, date(2020, 1, 5)), (4, date(2020, 1, 9)), (5, None)], ORDERS
    )


def ids(frame):
    return sorted(row["order_id"] for row in frame.collect())


def test_only_rows_after_the_mark(orders):
    stored = orders.filter("order_date <= '2020-01-05'")
    assert rows(watermark(stored, "order_date")) == [(date(2020, 1, 5),)]
    mark = watermark(stored, "order_date").scalar()
    assert ids(after_watermark(orders, "order_date", mark)) == [4]
    assert ids(after_watermark(orders, "order_date", date(2020, 1, 1))) == [2, 3, 4]
    assert ids(after_watermark(orders, "order_date", datetime(2020, 1, 1, 12))) == [2, 3, 4]


def test_an_empty_target(orders):
    mark = watermark(orders.limit(0), "order_date").scalar()
    assert ids(after_watermark(orders, "order_date", mark)) == []
    assert ids(after_watermark(orders, "order_date", None)) == []
    assert ids(after_watermark(orders, "order_date", mark, when_empty="all")) == [1, 2, 3, 4, 5]
    assert ids(after_watermark(orders, "order_date", None, when_empty="all")) == [1, 2, 3, 4, 5]


def test_late_rows_come_within_the_grace_days(orders):
    stored = orders.filter("order_id IN (2)")
    kept = late_or_after(orders, stored, "order_date", date(2020, 1, 5), 2, ["order_id"])
    assert ids(kept) == [3, 4]
    kept = late_or_after(orders, stored, "order_date", date(2020, 1, 5), 30, ["order_id"])
    assert ids(kept) == [1, 3, 4]


def test_a_snapshot_is_stamped_with_the_day(spark):
    stocks = spark.createDataFrame([(1, 2, 3)], "store_id long, product_id long, quantity long")
    snapshot = dated_snapshot(stocks, date(2020, 2, 29))
    assert snapshot.columns == ["store_id", "product_id", "quantity", "dt_stock"]
    assert rows(snapshot) == [(1, 2, 3, date(2020, 2, 29))]


def scanned(frame):
    """Rows that the scan of the plan handed on, once it has run."""
    frame.write.format("noop").mode("overwrite").save()
    plan = frame._jdf.queryExecution().executedPlan()
    frame._jdf.queryExecution().toRdd().count()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))


@pytest.mark.parametrize("spread", [True, False])
def test_late_ids_read_only_row_groups_that_may_hold_them(spark, tmp_path, settings, spread):
    """Even ids in one file of many row groups; late odd ids from all over the range."""
    settings(spark__sql__parquet__enableVectorizedReader="false", parquet__block__size="200000")
    lake = Lake(spark, LakeConfig(root=str(tmp_path), prefix=f"bloom{spread}_".lower()))
    rows = spark.range(0, 200_000, 1, 1).selectExpr("id * 2 as order_id", "id % 7 as product_id", "md5(string(id)) as filler")
    lake.append(rows.hint("rebalance").sortWithinPartitions("order_id") if not spread else rows, "bronze", "order_items")
    stored = lake.read("bronze", "order_items")
    late = spark.createDataFrame([(20_001,), (200_001,), (399_001,)], "order_id long")
    assert within_range(stored, late, "order_id").count() == 0
    assert scanned(within_range(stored, late, "order_id")) == 0
    assert scanned(within_range(stored, late, "order_id", few=0)) > 100_000  # the range alone
    known = spark.createDataFrame([(20_000,), (200_001,)], "order_id long")
    assert [row["order_id"] for row in within_range(stored, known, "order_id").collect()] == [20_000]
    lake.drop()


def test_thousands_of_ids_reach_the_scan(spark, tmp_path):
    """As one list and not as a chain of comparisons, which is too deep for a task's stack."""
    lake = Lake(spark, LakeConfig(root=str(tmp_path), prefix="many_ids_"))
    lake.append(spark.range(0, 100_000, 1, 1).selectExpr("id * 2 as order_id", "id % 7 as product_id"), "bronze", "order_items")
    wanted = spark.range(9_000).selectExpr("id * 20 as order_id")
    found = within_range(lake.read("bronze", "order_items"), wanted, "order_id")
    assert {row["order_id"] for row in found.collect()} == set(range(0, 180_000, 20))
    lake.drop()
