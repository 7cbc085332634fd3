from collections import Counter

import pytest
from conftest import final_plan, rows
from hypothesis import HealthCheck, given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starlift.operators import merged, not_in, rows_not_in, unseen_pairs

PAIRS = "order_id long, product_id long"
small = st.one_of(st.none(), st.integers(0, 3))
pairs = st.lists(st.tuples(small, small), max_size=12)
quick = hypothesis_settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def test_null_keys_in_the_pair(spark):
    source = spark.createDataFrame([(1, 10), (1, None), (None, 10), (2, 20)], PAIRS)
    target = spark.createDataFrame([(1, 10), (1, None), (None, 10), (None, 10)], PAIRS)
    assert rows(unseen_pairs(source, target)) == [(2, 20), (None, 10)]


@given(pairs, pairs)
@quick
def test_unseen_pairs_against_brute_force(spark, source, target):
    known = {pair for pair in target if pair[0] is not None}
    expected = Counter(pair for pair in source if pair not in known)
    result = unseen_pairs(spark.createDataFrame(source, PAIRS), spark.createDataFrame(target, PAIRS))
    assert Counter(tuple(row) for row in result.collect()) == expected


def test_a_second_line_of_a_stored_product_is_not_new(spark):
    schema = "order_id long, item_id long, product_id long"
    stored = spark.createDataFrame([(1, 1, 10)], schema)
    source = spark.createDataFrame([(1, 1, 10), (1, 2, 10), (1, 3, 11)], schema)
    assert rows(unseen_pairs(source, stored)) == [(1, 3, 11)]
    by_item = unseen_pairs(source, stored, keys=["order_id", "item_id"])
    assert rows(by_item) == [(1, 2, 10), (1, 3, 11)]


def test_keys_of_another_type_are_the_same_keys(spark):
    source = spark.createDataFrame([(1,), (2,)], "id long")
    target = spark.createDataFrame([(1.0,)], "id double")
    assert rows(rows_not_in(source, target, equal=["id"])) == [(2,)]


def test_merge_keeps_stored_rows_and_source_duplicates(spark):
    stored = spark.createDataFrame([(1, "old"), (None, "no key")], "id long, name string")
    source = spark.createDataFrame([(1, "new"), (2, "b"), (2, "b"), (None, "no key")], "id long, name string")
    assert rows(merged(source, stored, "id")) == sorted(
        [(1, "old"), (None, "no key"), (2, "b"), (2, "b"), (None, "no key")], key=repr
    )


@pytest.mark.parametrize(
    ("existing", "null_aware", "expected"),
    [
        ([1], True, [2]),
        ([1, None], True, []),
        ([], True, [1, 2, None]),
        ([1], False, [2, None]),
        ([1, None], False, [2]),
        ([], False, [1, 2, None]),
    ],
)
def test_not_in(spark, existing, null_aware, expected):
    candidates = spark.createDataFrame([(1,), (2,), (None,)], "id long")
    known = spark.createDataFrame([(value,) for value in existing], "id long")
    result = not_in(candidates, known, "id", null_aware)
    assert rows(result) == [(value,) for value in expected]
    if null_aware:
        candidates.createOrReplaceTempView("candidates")
        known.createOrReplaceTempView("known")
        assert rows(result) == rows(spark.sql("SELECT * FROM candidates WHERE id NOT IN (SELECT id FROM known)"))


@given(st.lists(small, max_size=8), st.lists(small, max_size=6))
@quick
def test_not_in_against_sql(spark, candidates, existing):
    spark.createDataFrame([(value,) for value in candidates], "id long").createOrReplaceTempView("candidates")
    spark.createDataFrame([(value,) for value in existing], "id long").createOrReplaceTempView("known")
    result = not_in(spark.table("candidates"), spark.table("known"), "id")
    assert rows(result) == rows(spark.sql("SELECT * FROM candidates WHERE id NOT IN (SELECT id FROM known)"))


@pytest.fixture
def shuffled_joins(settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
    )


def hot_orders(spark, rows=60_000):
    """Two thirds of the rows have one key."""
    return spark.range(0, rows, 1, 12).select(
        F.when(F.col("id") % 3 > 0, F.lit(77)).otherwise(F.col("id")).alias("order_id"),
        F.when(F.col("id") % 3 > 0, F.lit(5)).otherwise(F.col("id") % 50).alias("product_id"),
        F.xxhash64("id").alias("payload"),
    )


@pytest.mark.parametrize("stored", [False, True])
def test_a_hot_key_is_split_and_kept_whole(spark, shuffled_joins, stored):
    source = hot_orders(spark)
    target = source.filter(F.col("order_id") % 2 == 1) if stored else source.filter(F.col("order_id") % 2 == 0)
    fresh = unseen_pairs(source, target.select("order_id", "product_id"))
    whole = (F.count("*"), F.sum(F.col("payload") % 1000))
    found = fresh.agg(*whole)
    expected = source.filter(F.col("order_id") % 2 == (0 if stored else 1)).agg(*whole)
    assert rows(found) == rows(expected)
    assert "skew=true" in final_plan(found)


def test_the_target_is_reduced_before_its_shuffle(spark, shuffled_joins):
    plan = unseen_pairs(hot_orders(spark), hot_orders(spark))._jdf.queryExecution().executedPlan().toString()
    target = plan[plan.rindex("HashAggregate") :]
    assert "Exchange" not in target.split("Range")[0]  # partial distinct sits right on the scan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_keys_of_other_types_are_compared_in_the_wider_one(spark):
    source = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    target = spark.createDataFrame([(1.5,), (2.0,)], "id double")
    assert rows(rows_not_in(source, target, equal=["id"])) == [(1,), (3,)]
    assert rows_not_in(source, target, null_safe=["id"]).schema == source.schema
