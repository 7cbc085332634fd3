from conftest import rows
from hypothesis import HealthCheck, given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from starlift.operators.keys import dense_keys


def by_window(frame, order):
    window = Window.orderBy(*[F.col(column).asc_nulls_last() for column in order])
    return frame.select(F.row_number().over(window).cast("long").alias("sk"), "*")


def test_null_ids_come_last(spark):
    ids = spark.createDataFrame([(2,), (None,), (1,)], "id long")
    assert rows(dense_keys(ids, "sk", ["id"])) == [(1, 1), (2, 2), (3, None)]


def test_same_keys_as_a_global_window_over_many_partitions(spark, settings, sf_dir):
    settings(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="13")
    order = ["l_partkey", "l_orderkey", "l_linenumber"]
    parts = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*order).distinct()
    keyed = dense_keys(parts, "sk", order)
    assert keyed.select(F.spark_partition_id()).distinct().count() > 1
    expected = by_window(parts, order)
    assert keyed.exceptAll(expected).count() == 0
    assert expected.exceptAll(keyed).count() == 0
    assert keyed.schema["sk"].dataType.simpleString() == "bigint"


def test_an_id_with_most_of_the_rows_is_spread(spark, settings):
    settings(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="8")
    names = spark.range(8000).select(
        F.when(F.col("id") % 3 > 0, F.lit(5)).otherwise(F.col("id")).alias("member"),
        F.concat(F.lit("name "), "id").alias("name"),
    )
    keyed = dense_keys(names, "sk", ["member", "name"])
    assert keyed.exceptAll(by_window(names, ["member", "name"])).count() == 0
    sizes = [row["count"] for row in keyed.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 3000


def test_keys_follow_a_number_or_a_scalar(spark):
    ids = spark.createDataFrame([(7,), (9,)], "id long")
    assert rows(dense_keys(ids, "sk", ["id"], after=10)) == [(11, 7), (12, 9)]
    highest = spark.createDataFrame([(4,)], "sk long").agg(F.max("sk")).scalar()
    assert rows(dense_keys(ids, "sk", ["id"], after=highest)) == [(5, 7), (6, 9)]


def test_no_rows_no_keys(spark):
    assert dense_keys(spark.createDataFrame([], "id long"), "sk", ["id"]).count() == 0


def test_no_single_task_sort(spark, sf_dir):
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey")
    plan = dense_keys(parts, "sk", ["p_partkey"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan and "Join" not in plan


member = st.tuples(st.one_of(st.none(), st.integers(0, 50)), st.text("ab", max_size=3))


@given(st.lists(member, max_size=40, unique=True))
@hypothesis_settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_any_members(spark, members):
    frame = spark.createDataFrame(members, "id long, name string").repartition(5)
    ordered = sorted(members, key=lambda row: (row[0] is None, row[0] or 0, row[1]))
    expected = [(place, *row) for place, row in enumerate(ordered, 1)]
    assert sorted(tuple(row) for row in dense_keys(frame, "sk", ["id", "name"]).collect()) == expected


@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 50)), st.text("ab", max_size=2)), max_size=40, unique=True))
@hypothesis_settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_each_group_is_numbered_on_its_own(spark, members):
    frame = spark.createDataFrame(members, "kind int, id long, name string").repartition(5)
    ordered = sorted(members, key=lambda row: (row[0], row[1] is None, row[1] or 0, row[2]))
    expected, place = [], {}
    for row in ordered:
        place[row[0]] = place.get(row[0], 0) + 1
        expected.append((place[row[0]], *row))
    assert sorted((tuple(row) for row in dense_keys(frame, "sk", ["id", "name"], within="kind").collect()), key=repr) == sorted(expected, key=repr)
