"""Control queries over a loaded warehouse."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.measures import distinct, finish, lines, mean, money, rate, summarize
from orderloom.functions.rounding import round_half_away
from orderloom.operators.parts import Grouping, folded, has_parts, united

Star = Mapping[str, DataFrame]


TOTALS = Grouping(
    None,
    (),
    (
        money("sales", "total_revenue"),
        money("profit", "total_profit"),
        mean("profit_margin_pct", "avg_margin_pct"),
        distinct("order_id", "total_orders"),
        distinct("customer_id", "total_customers"),
    ),
)
STATUS = Grouping(None, ("delivery_status",), (lines("order_count"),))
MARKETS = Grouping(
    "dim_geography",
    ("market",),
    (money("sales", "total_revenue"), mean("profit_margin_pct", "avg_margin"), distinct("order_id", "total_orders")),
)
CATEGORIES = Grouping(
    "dim_products", ("category",), (money("sales", "total_revenue"), money("profit", "total_profit"), lines("order_lines"))
)
SEGMENTS = Grouping(
    "dim_customers",
    ("segment",),
    (distinct("order_id", "total_orders"), money("sales", "total_revenue"), mean("profit_margin_pct", "avg_margin_pct")),
)
YEARS = Grouping(
    "dim_date",
    ("year",),
    (
        distinct("order_id", "total_orders"),
        money("sales", "total_revenue"),
        rate("on_time_flag", "on_time_rate_pct"),
        mean("profit_margin_pct", "avg_margin_pct"),
        money("revenue_at_risk", "revenue_at_risk"),
    ),
)
#: What the checks need of a batch, by grouping.
GROUPINGS = united([TOTALS, STATUS, MARKETS, CATEGORIES, SEGMENTS, YEARS])


def _figures(star: Star, g: Grouping) -> DataFrame:
    """The measures of a grouping, from the stored parts of all batches or from the fact."""
    if not has_parts(star) and not g.keys:
        return summarize(star["fact_orders"], [], g.measures)
    return finish(folded(star, g.through, g.keys, g.measures), g.keys, g.measures)


def totals(star: Star) -> DataFrame:
    return _figures(star, TOTALS)


def delivery_status_share(star: Star) -> DataFrame:
    """Lines per delivery status and their share; the window sees one row per status."""
    counts = _figures(star, STATUS)
    all_lines = F.sum("order_count").over(Window.partitionBy())
    share = F.col("order_count").cast("double") * F.lit(100.0) / all_lines.cast("double")
    return counts.withColumn("pct", round_half_away(share, 2)).orderBy(F.desc("order_count"), "delivery_status")


def revenue_by_market(star: Star) -> DataFrame:
    return _figures(star, MARKETS).orderBy(F.desc("total_revenue"), "market")


def top_categories(star: Star) -> DataFrame:
    return _figures(star, CATEGORIES).orderBy(F.desc("total_revenue"), "category").limit(5)


def segment_performance(star: Star) -> DataFrame:
    return _figures(star, SEGMENTS).orderBy(F.desc("total_revenue"), "segment")


def yearly_summary(star: Star) -> DataFrame:
    return _figures(star, YEARS).orderBy("year")


def supplier_summary(star: Star) -> DataFrame:
    """The eight suppliers with the highest revenue, from the supplier rollup."""

    def r2(c):
        return round_half_away(F.col(c), 2)

    return (
        star["supplier_metrics"]
        .select(
            "department_name",
            "total_orders",
            r2("total_revenue").alias("total_revenue"),
            r2("on_time_rate_pct").alias("on_time_rate_pct"),
            r2("fulfillment_rate").alias("fulfillment_rate_pct"),
            r2("cancellation_rate").alias("cancellation_rate_pct"),
            r2("avg_lead_time_days").alias("avg_lead_time_days"),
        )
        .orderBy(F.desc("total_revenue"), "department_name")
        .limit(8)
    )
