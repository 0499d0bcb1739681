"""Business columns of an order line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.measures import mean, money, summarize
from orderloom.functions.rounding import round_half_away
from orderloom.schemas import PERCENT

DELIVERY_DELAY = "delivery_delay_days"


def delivery_delay(df: DataFrame) -> DataFrame:
    """Actual minus scheduled shipping days."""
    return df.withColumn(DELIVERY_DELAY, F.col("days_shipping_real") - F.col("days_shipping_scheduled"))


def on_time(df: DataFrame) -> DataFrame:
    """1 when the line was delivered on the scheduled day or earlier; needs the delay."""
    return df.withColumn("on_time_flag", _flag(F.col(DELIVERY_DELAY) <= 0))


def profit_margin(df: DataFrame) -> DataFrame:
    """Profit in percent of sales; 0 for zero or missing sales."""
    sales, profit = F.col("sales").cast("double"), F.col("profit").cast("double")
    percent = round_half_away(F.try_divide(profit, sales) * F.lit(100.0), 2).cast(PERCENT)
    return df.withColumn("profit_margin_pct", F.when(F.col("sales") != 0, percent).otherwise(F.lit(0).cast(PERCENT)))


def cancelled(df: DataFrame) -> DataFrame:
    return df.withColumn("is_cancelled", _flag(F.lower("order_status") == "canceled"))


def fulfilled(df: DataFrame) -> DataFrame:
    """Neither the order nor its shipping was cancelled; needs the cancelled flag."""
    shipped = F.lower("delivery_status") != "shipping canceled"
    return df.withColumn("is_fulfilled", _flag((F.col("is_cancelled") == 0) & shipped))


def revenue_at_risk(df: DataFrame) -> DataFrame:
    """Sales of unfulfilled lines, else 0; needs the fulfilled flag."""
    zero = F.lit(0).cast(df.schema["sales"].dataType)
    return df.withColumn("revenue_at_risk", F.when(F.col("is_fulfilled") == 0, F.col("sales")).otherwise(zero))


def cost_per_order(df: DataFrame) -> DataFrame:
    """List price times quantity minus profit, in as many digits as the product needs."""
    return df.withColumn("cost_per_order", F.col("unit_price") * F.col("quantity") - F.col("profit"))


def perfect_order(df: DataFrame) -> DataFrame:
    """On time and fulfilled; needs both flags."""
    return df.withColumn("perfect_order_flag", _flag((F.col("on_time_flag") == 1) & (F.col("is_fulfilled") == 1)))


def processing_days(df: DataFrame) -> DataFrame:
    return df.withColumn("processing_days", F.datediff("ship_date", "order_date"))


def order_week(df: DataFrame) -> DataFrame:
    """ISO week of the order date."""
    return df.withColumn("order_week", F.weekofyear("order_date"))


def order_flags(df: DataFrame) -> DataFrame:
    """The seven columns that cleaning adds."""
    for step in (delivery_delay, on_time, profit_margin, cancelled, fulfilled, revenue_at_risk, cost_per_order):
        df = step(df)
    return df


def enrich_orders(df: DataFrame) -> DataFrame:
    """All ten business columns; recomputed from their inputs when already there."""
    for step in (order_flags, perfect_order, processing_days, order_week):
        df = step(df)
    return df


def derived_summary(df: DataFrame) -> DataFrame:
    """Control figures of the derived columns, one row."""
    return summarize(
        df,
        [],
        [
            mean(DELIVERY_DELAY, "mean_delay_days"),
            mean("on_time_flag", "on_time_pct", 1, 100.0),
            mean("profit_margin_pct", "mean_margin_pct"),
            mean("is_cancelled", "cancelled_pct", 1, 100.0),
            mean("is_fulfilled", "fulfilled_pct", 1, 100.0),
            money("revenue_at_risk", "total_revenue_at_risk"),
            mean("cost_per_order", "mean_cost_per_order"),
        ],
    )


def _flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it fails or is unknown."""
    return F.when(condition, 1).otherwise(0)
