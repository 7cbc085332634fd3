import warnings

import pytest
from conftest import final_plan, rows
from test_pipeline import DAY_1, DAY_2, FIRST, SECOND, write

from starlift import Lake, LakeConfig
from starlift.plans import run_all, run_gold, run_layers, serving
from starlift.plans.pipeline import FanOut


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("serving")
    made = Lake(spark, LakeConfig(root=str(folder / "lake"), prefix="serving_"))
    run_all(made, write(folder / "first", FIRST), DAY_1)
    run_all(made, write(folder / "second", SECOND), DAY_2)
    yield made
    made.drop()


def scans(plan):
    return plan.count("FileScan")


def test_the_view_has_every_sale_with_its_attributes(spark, lake):
    view = spark.table(serving.create_view(lake))
    assert rows(view.select("order_id", "customer_name", "product_name", "store_name", "year", "month", "day")) == [
        (100, "Ann Lee", 'Bike 16"', "North", 2020, 1, 10),
        (101, "Cy Moe", 'Bike 16"', "North", 2020, 1, 20),
        (102, "Bo Kim", "Fork", "North", 2020, 1, 25),
        (103, "Ann Lee", "Fork", "North", 2020, 2, 2),
    ]


@pytest.mark.parametrize("columns, tables", [("quantity", 1), ("category_name, quantity", 2), ("category_name, year, quantity", 3), ("*", 6)])
def test_unused_dimensions_leave_the_plan(spark, lake, columns, tables):
    plan = spark.sql(f"SELECT {columns} FROM {serving.create_view(lake)}")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation ") == tables


def test_a_condition_on_the_calendar_skips_months(spark, lake):
    asked = spark.sql(f"SELECT order_id, month FROM {serving.create_view(lake)} WHERE year = 2020 AND month = 2")
    assert rows(asked) == [(103, 2)]
    plan = final_plan(asked)
    assert "dynamicpruning" in plan and "BroadcastHashJoin" in plan


def test_a_view_needs_its_tables(spark, tmp_path):
    empty = Lake(spark, LakeConfig(root=str(tmp_path), prefix="noserving_"))
    with pytest.raises(ValueError, match="fact_sales"):
        serving.create_view(empty)


def test_a_renamed_member_is_reported_with_its_count(spark, tmp_path):
    """The name of a customer changes between two loads of silver, before gold is first built."""
    lake = Lake(spark, LakeConfig(root=str(tmp_path / "lake"), prefix="renamed_"))
    before_gold = ("landing", "bronze", "silver")
    run_layers(lake, before_gold, write(tmp_path / "first", FIRST), DAY_1)
    lake.overwrite(lake.read("bronze", "customers").replace("Ann", "Anna"), "bronze", "customers")
    run_layers(lake, before_gold, write(tmp_path / "second", SECOND), DAY_2)
    with pytest.warns(FanOut, match=r"4 sales became 6 facts; ids with several members: \{'dim_customers': 1\}"):
        run_gold(lake, DAY_2)
    with warnings.catch_warnings():
        warnings.simplefilter("error", FanOut)
        run_gold(lake, DAY_2)  # nothing new, nothing to report
    lake.drop()
