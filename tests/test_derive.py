import datetime as dt
from decimal import Decimal

import pytest

from orderloom.operators.derive import derived_summary, enrich_orders, order_flags

SCHEMA = (
    "order_id bigint, days_shipping_real int, days_shipping_scheduled int, sales decimal(12,2), profit decimal(16,4), "
    "unit_price decimal(12,2), quantity int, order_status string, delivery_status string, order_date timestamp, "
    "ship_date timestamp"
)


def _line(real=2, scheduled=4, sales="100", profit="10", status="Complete", delivery="Advance Shipping",
          ordered=dt.datetime(2015, 6, 1), shipped=dt.datetime(2015, 6, 3)):
    money = [None if v is None else Decimal(v) for v in (sales, profit, "60")]
    return (1, real, scheduled, *money, 2, status, delivery, ordered, shipped)


@pytest.fixture
def enriched(spark):
    def run(*lines):
        return enrich_orders(spark.createDataFrame(list(lines), SCHEMA)).collect()

    return run


def test_delay_zero_is_on_time(enriched):
    early, exact, late = enriched(_line(1, 4), _line(4, 4), _line(5, 4))
    assert [r["delivery_delay_days"] for r in (early, exact, late)] == [-3, 0, 1]
    assert [r["on_time_flag"] for r in (early, exact, late)] == [1, 1, 0]


def test_margin_zero_and_missing_sales(enriched):
    plain, zero, missing, third = enriched(_line(), _line(sales="0"), _line(sales=None), _line(sales="3", profit="1"))
    assert [r["profit_margin_pct"] for r in (plain, zero, missing, third)] == [
        Decimal("10.00"), Decimal("0.00"), Decimal("0.00"), Decimal("33.33")]


def test_margin_rounds_half_away_from_zero(enriched):
    up, down = enriched(_line(sales="1000", profit="1.25"), _line(sales="1000", profit="-1.25"))
    assert (up["profit_margin_pct"], down["profit_margin_pct"]) == (Decimal("0.13"), Decimal("-0.13"))


def test_cancelled_is_case_blind_but_not_blank_blind(enriched):
    upper, padded, fraud = enriched(_line(status="CANCELED"), _line(status=" canceled "), _line(status="Suspected_Fraud"))
    assert [r["is_cancelled"] for r in (upper, padded, fraud)] == [1, 0, 0]


def test_shipping_cancelled_is_unfulfilled_without_being_cancelled(enriched):
    (row,) = enriched(_line(status="Suspected_Fraud", delivery="Shipping canceled"))
    assert (row["is_cancelled"], row["is_fulfilled"], row["perfect_order_flag"]) == (0, 0, 0)
    assert row["revenue_at_risk"] == Decimal("100.00")


def test_cost_risk_and_perfect_order(enriched):
    (row,) = enriched(_line())
    assert row["cost_per_order"] == Decimal("110.0000")
    assert row["revenue_at_risk"] == 0
    assert row["perfect_order_flag"] == 1


def test_calendar_columns(enriched):
    (row,) = enriched(_line(ordered=dt.datetime(2016, 1, 1, 23, 59), shipped=dt.datetime(2016, 1, 3, 0, 1)))
    assert (row["processing_days"], row["order_week"]) == (2, 53)


def test_unknown_values_give_zero_flags(enriched):
    (row,) = enriched(_line(real=None, status=None, delivery=None))
    assert (row["on_time_flag"], row["is_cancelled"], row["is_fulfilled"]) == (0, 0, 0)


def test_doubles_work_too(spark):
    df = spark.createDataFrame([(1, 2, 4, 100.0, 10.0, 60.0, 2, "Complete", "x")],
        "order_id bigint, days_shipping_real int, days_shipping_scheduled int, sales double, profit double, "
        "unit_price double, quantity int, order_status string, delivery_status string")
    assert order_flags(df).first()["cost_per_order"] == 110.0


def test_summary(spark):
    df = order_flags(spark.createDataFrame([_line(5, 4), _line(), _line(status="Canceled")], SCHEMA))
    row = derived_summary(df).first()
    assert row["on_time_pct"] == 66.7
    assert row["total_revenue_at_risk"] == 100.0
