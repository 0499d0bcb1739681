"""A third of all rows on one key: the work is split or folded, and nothing is lost."""

import re

import pytest
from pyspark.sql import functions as F

from orderloom.operators.clean import split_customers, split_products
from orderloom.operators.keys import keep_first
from orderloom.operators.star import star_join
from orderloom.plans import checks, kpis
from orderloom.operators.parts import without_parts


@pytest.fixture
def hot_star(spark, star):
    """Every third line belongs to customer 1, product 1; many more lines than usual."""
    hot = F.pmod(F.hash("order_item_id", "copy"), F.lit(3)) == 0
    fact = star["fact_orders"].crossJoin(spark.range(40).select(F.col("id").alias("copy")))
    fact = fact.withColumns({c: F.when(hot, F.lit(1).cast("bigint")).otherwise(F.col(c)) for c in ("customer_id", "product_id")})
    return {**without_parts(star), "fact_orders": fact.drop("copy")}


@pytest.fixture
def small_partitions(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_star_join_splits_a_hot_customer(hot_star, small_partitions):
    # Wide and incompressible enough that the hot partition stands out.
    joined = star_join(hot_star, ["segment"]).select("order_item_id", "sales", "profit", "order_id", "segment")
    plan = _final_plan(joined)
    assert "skewed" in plan
    assert joined.count() == hot_star["fact_orders"].count()


def test_distinct_counts_over_a_hot_key_are_whole(hot_star, small_partitions):
    rows = checks.segment_performance(hot_star).collect()
    expected = (
        hot_star["fact_orders"].join(hot_star["dim_customers"].select("customer_id", "segment"), "customer_id")
        .groupBy("segment").agg(F.count_distinct("order_id").alias("n")).collect()
    )
    assert {r["segment"]: r["total_orders"] for r in rows} == {r["segment"]: r["n"] for r in expected}


def test_folded_kpi_moves_keys_not_lines(hot_star, small_partitions):
    """What reaches the join is at most one row per product and task, hot product included."""
    df = kpis.kpi(hot_star, "kpi09_perfect_order_by_category")
    total = sum(r["total_orders"] for r in df.collect())
    assert total == hot_star["fact_orders"].join(hot_star["dim_products"].select("product_id"), "product_id").count()
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [product_id" in plan[plan.index("Join Inner"):]


def test_keep_first_combines_before_the_shuffle(hot_star, star):
    df = split_customers(star["lines"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_min(struct" in plan and "Window" not in plan


@pytest.mark.parametrize("split", [split_customers, split_products])
def test_keep_first_does_not_sort_the_lines(star, split):
    """Lines are folded by hashing; only what is left of them meets the struct, whose aggregate sorts."""
    plan = split(star["lines"])._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"(\w+Aggregate)\(", plan)[-1] == "HashAggregate"


def test_keep_first_is_the_smallest_struct_whatever_is_null_or_repeated(spark):
    rows = [(None, 4, "x", 1), (None, 3, None, 2), (1, 7, "b", 1), (1, 7, "b", 1), (1, 7, "a", 9), (1, 8, None, 0)]
    rows += [(2, None, "z", 5), (2, None, "y", 6), (2, 1, "a", 0), (3, 2, None, None), (3, 2, None, 1)]
    df = spark.createDataFrame(rows * 3, "k int, item long, name string, n int").repartition(5)
    found = {tuple(r) for r in keep_first(df, "k", ["item"], ["k", "name", "n"]).collect()}
    assert found == {(None, None, 2), (1, "a", 9), (2, "y", 6), (3, None, None)}
    signed = df.select("k", "item", F.lit("-0.0").cast("double").alias("v"))
    assert {str(r["v"]) for r in keep_first(signed, "k", ["item"], ["k", "v"]).collect()} == {"-0.0"}
