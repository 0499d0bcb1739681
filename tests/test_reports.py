import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderloom.operators import quality
from orderloom.plans import reports


@pytest.fixture
def base(spark):
    day = dt.datetime(2016, 1, 2)  # a Saturday
    rows = [
        (1, 1, 2016, 1, "Europe", "Consumer", "Toys", "Golf", day, Decimal("100"), Decimal("-1"), 1, 1, 0, 1),
        (1, 2, 2016, 1, "Europe", "Consumer", "Toys", "Golf", day, Decimal("0"), Decimal("1"), 0, 1, 0, 0),
        (None, 2, 2017, 11, "Africa", "Corporate", None, "Golf", day, None, Decimal("1"), 1, 0, 1, 0),
        (3, None, None, None, "Africa", "Corporate", "Books", None, None, Decimal("50"), Decimal("1"), 1, 1, 0, 1),
        (3, None, 2017, 2, "Africa", "Corporate", "Books", "Art", day, Decimal("50"), Decimal("1"), 1, 1, 0, 1),
    ]
    return spark.createDataFrame(
        rows,
        "order_id bigint, order_item_id bigint, year int, month int, market string, segment string, category string, "
        "department_name string, order_date timestamp, sales decimal(12,2), profit decimal(16,4), on_time_flag int, "
        "is_fulfilled int, is_cancelled int, perfect_order_flag int",
    )


def test_empty_choice_means_all_but_null_never_passes(base):
    assert reports.report_filter(base).count() == 3
    assert reports.report_filter(base, years=[2017]).count() == 1
    assert reports.report_filter(base, years=[2016], markets=["Africa"]).count() == 0
    assert reports.report_filter(base, segments=["Consumer"], categories=["Toys"]).count() == 2


def test_filter_reaches_the_dimensions(star):
    plan = reports.report_base(star, years=[1996], markets=["ASIA"])._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in plan


def test_chosen_years_prune_partitions_of_the_fact(star):
    plan = reports.report_base(star, years=[1996, 1997])._jdf.queryExecution().executedPlan().toString()
    assert any("order_year" in p.split("]")[0] for p in plan.split("PartitionFilters: [")[1:])
    years = reports.report_base(star, years=[1996, 1997]).select("year").distinct().collect()
    assert {r["year"] for r in years} == {1996, 1997}


def test_period_label(base):
    rows = reports.monthly_revenue_profit(base).collect()
    assert [r["period"] for r in rows] == ["2016-01", "2017-02", "2017-11"]


def test_groups_without_key_do_not_exist(base):
    assert {r["category"] for r in reports.fulfillment_by_category(base).collect()} == {"Toys", "Books"}


def test_weekday_rows_are_always_seven(base):
    rows = reports.orders_by_weekday(base).collect()
    assert [r["order_dow"] for r in rows] == list(reports.WEEKDAYS)
    assert {r["order_dow"]: r["orders"] for r in rows}["Saturday"] == 3
    assert sum(r["orders"] for r in rows) == 3


def test_numeric_weekdays_count_from_sunday(spark):
    df = spark.createDataFrame([(1, 1), (2, 7), (3, 2)], "order_id int, order_dow int")
    found = {r["order_dow"]: r["orders"] for r in reports.orders_by_weekday(df).collect() if r["orders"]}
    assert found == {"Sunday": 1, "Saturday": 1, "Monday": 1}


def test_best_and_worst_take_the_first_name_on_a_tie(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("d", 0), ("c", 0)], "department_name string, on_time_flag int")
    assert tuple(reports.supplier_best_worst(df).first()) == (4, "a", "c")


def test_health_report(base):
    found = {r["check"]: (r["value"], r["status"]) for r in quality.health_report(base).collect()}
    assert found == {
        "total_records": (5, "good"),
        "null_order_id": (1, "bad"),
        "null_sales": (1, "bad"),
        "negative_profit": (1, "neutral"),
        "zero_sales": (1, "neutral"),
        "duplicate_items": (2, "bad"),  # item 2 twice, the missing item twice
    }


def test_health_report_of_nothing(base):
    found = {r["check"]: (r["value"], r["status"]) for r in quality.health_report(base.where("year = 1")).collect()}
    assert found["total_records"] == (0, "bad") and found["duplicate_items"] == (0, "good")


def _flags(spark, on_time, n=10):
    data = [(int(i < on_time), Decimal("15")) for i in range(n)]
    return spark.createDataFrame(data, "on_time_flag int, profit_margin_pct decimal(18,2)")


def test_scorecard_at_its_target_is_good_and_missing_counts_as_zero(spark):
    found = {r["kpi"]: (r["value"], r["status"]) for r in quality.scorecard(_flags(spark, 7)).collect()}
    assert found["On-Time Delivery Rate"] == (70.0, "GOOD")
    assert found["Avg Profit Margin"] == (15.0, "GOOD")
    assert found["Fulfillment Rate"] == (0.0, "AT RISK")
    assert found["Cancellation Rate"] == (0.0, "GOOD")


def test_card_at_its_limit_is_bad(spark, star):
    df = _flags(spark, 7).selectExpr(
        "on_time_flag", "profit_margin_pct", "1 AS order_id", "cast(100 AS decimal(12,2)) AS sales",
        "cast(1 AS decimal(16,4)) AS profit", "1 AS is_fulfilled", "0 AS is_cancelled", "on_time_flag AS perfect_order_flag",
        "0 AS delivery_delay_days", "cast(1 AS decimal(16,4)) AS cost_per_order", "cast(5 AS decimal(12,2)) AS revenue_at_risk")
    found = {r["card"]: r["status"] for r in reports.exec_card_status(df).collect()}
    assert (found["on_time"], found["avg_margin"]) == ("bad", "bad")
    assert (found["avg_delay"], found["risk_pct"], found["total_orders"]) == ("good", "good", "neutral")


def test_risk_is_zero_without_revenue(spark, base):
    df = base.where("sales = 0").withColumn("revenue_at_risk", F.col("sales")).withColumn("profit_margin_pct", F.col("sales"))
    df = df.withColumn("cost_per_order", F.col("sales"))
    assert {r["card"]: r["value"] for r in reports.cost_risk_cards(df).collect()}["risk_pct"] == 0.0
