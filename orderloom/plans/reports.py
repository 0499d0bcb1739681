"""Aggregates behind the five report pages, over one filtered star join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from orderloom.functions.dates import day_name, period_label
from orderloom.functions.measures import (
    Measure,
    distinct,
    filled,
    lines,
    mean,
    money,
    quantity,
    rate,
    ratio,
    ratio_or_zero,
    summarize,
)
from orderloom.functions.rounding import round_half_away
from orderloom.operators.star import star_join
from orderloom.schemas import FACT_COLUMNS, YEAR

Star = Mapping[str, DataFrame]

#: The table of fact rows with all report attributes, written once for each batch.
REPORT_BASE = "report_base"
FILTERS = ("year", "market", "segment", "category")
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def report_filter(
    base: DataFrame,
    years: Sequence[int] = (),
    markets: Sequence[str] = (),
    segments: Sequence[str] = (),
    categories: Sequence[str] = (),
) -> DataFrame:
    """Rows that match every choice. An empty choice means all values; null never matches.

    The conditions reject nulls, so over a star join Spark turns the left joins into inner
    joins and filters the dimensions before joining.
    """
    for column, chosen in zip(FILTERS, (years, markets, segments, categories)):
        base = base.where(F.col(column).isin(*chosen) if chosen else F.col(column).isNotNull())
    return base


def report_base(star: Star, attributes: Sequence[str] = (), **choices) -> DataFrame:
    """Filtered report rows with the filter columns and the attributes a page uses.

    A stored warehouse holds the joined rows, see ``REPORT_BASE``; pages then scan the columns they use, without a
    join. Stored rows are partitioned by order year, so chosen years are also asked of the table
    itself and other years are not read at all. Without the stored table the star is joined here.
    """
    name = REPORT_BASE if REPORT_BASE in star else "fact_orders"
    rows, years = star[name], choices.get("years")
    if years and YEAR in rows.columns:
        rows = rows.where(F.col(YEAR).isin(*years))
    if name == REPORT_BASE:
        return report_filter(rows, **choices).select(*FACT_COLUMNS, *FILTERS, *[a for a in attributes if a not in FILTERS])
    return report_filter(star_join({**star, name: rows}, [*FILTERS, *attributes]), **choices)


def filter_options(star: Star) -> DataFrame:
    """What each filter offers: the different values that occur in the report base.

    A value is offered when some fact row refers to it; keys are made distinct before
    they meet their dimension.
    """
    sources = {
        "year": ("dim_date", "date_id"),
        "market": ("dim_geography", "geo_id"),
        "segment": ("dim_customers", "customer_id"),
        "category": ("dim_products", "product_id"),
    }
    options = None
    for column, (dim, key) in sources.items():
        used = star[dim].join(star["fact_orders"].select(key).distinct(), key, "left_semi")
        values = used.select(F.col(column).cast("string").alias("value")).where("value IS NOT NULL").distinct()
        values = values.select(F.lit(column).alias("filter"), "value")
        options = values if options is None else options.unionByName(values)
    return options.orderBy("filter", "value")


def _by(base: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Group by keys; rows with a null key belong to no group."""
    for k in keys:
        base = base.where(F.col(k).isNotNull())
    return summarize(base, list(keys), measures)


# ── page 1: executive summary ──


def exec_cards(base: DataFrame) -> DataFrame:
    return summarize(
        base,
        [],
        [
            distinct("order_id", "total_orders"),
            money("sales", "total_revenue", None),
            money("profit", "total_profit", None),
            mean("profit_margin_pct", "avg_margin", None),
            rate("on_time_flag", "on_time", None),
            rate("is_fulfilled", "fulfill", None),
            rate("is_cancelled", "cancel", None),
            rate("perfect_order_flag", "perfect", None),
            mean("delivery_delay_days", "avg_delay", None),
            mean("cost_per_order", "avg_cost", None),
            money("revenue_at_risk", "rev_at_risk", None),
            ratio_or_zero("revenue_at_risk", "sales", "risk_pct"),
        ],
    )


def _good(condition: Column) -> Column:
    return F.when(condition, "good").otherwise("bad")


def exec_card_status(base: DataFrame) -> DataFrame:
    """One row per card: value and good / bad / neutral. A value at its limit is not good, except no delay and 5 % risk."""
    c = F.col
    # The limits of the cards.
    status = {
        "total_orders": F.lit("neutral"),
        "total_revenue": F.lit("neutral"),
        "total_profit": _good(c("total_profit") > 0),
        "avg_margin": _good(c("avg_margin") > 15),
        "on_time": _good(c("on_time") > 70),
        "fulfill": _good(c("fulfill") > 90),
        "cancel": _good(c("cancel") < 5),
        "perfect": _good(c("perfect") > 70),
        "avg_delay": _good(c("avg_delay") <= 0),
        "avg_cost": F.lit("neutral"),
        "rev_at_risk": _good(c("risk_pct") <= 5),
        "risk_pct": _good(c("risk_pct") <= 5),
    }
    return _cards(exec_cards(base), status)


def _cards(row: DataFrame, status: Mapping[str, Column]) -> DataFrame:
    cards = [
        F.struct(F.lit(name).alias("card"), F.col(name).cast("double").alias("value"), rule.alias("status"))
        for name, rule in status.items()
    ]
    return row.select(F.inline(F.array(*cards)))


def monthly_revenue_profit(base: DataFrame) -> DataFrame:
    months = _by(base, ["year", "month"], [money("sales", "revenue", None), money("profit", "profit", None)])
    return _with_period(months)


def _with_period(months: DataFrame) -> DataFrame:
    return months.withColumn("period", period_label(F.col("year"), F.col("month"))).orderBy("year", "month")


def revenue_by_market(base: DataFrame) -> DataFrame:
    """Revenue per market and its share of all markets, in percent."""
    markets = _by(base, ["market"], [money("sales", "revenue", None)])
    share = F.try_divide(F.col("revenue"), F.sum("revenue").over(Window.partitionBy())) * F.lit(100.0)
    return markets.withColumn("share_pct", round_half_away(share, 6)).orderBy(F.desc("revenue"), "market")


def delivery_status_counts(base: DataFrame) -> DataFrame:
    return _by(base, ["delivery_status"], [lines("count")]).orderBy("count", "delivery_status")


# ── page 2: supplier performance ──


def supplier_table(base: DataFrame) -> DataFrame:
    rows = _by(
        base,
        ["department_name"],
        [
            filled("order_id", "total_orders"),
            money("sales", "total_revenue", 0),
            rate("on_time_flag", "on_time_pct", 1),
            rate("is_fulfilled", "fulfill_pct", 1),
            rate("is_cancelled", "cancel_pct", 1),
            rate("perfect_order_flag", "perfect_pct", 1),
            mean("days_shipping_real", "avg_lead_time", 1),
            mean("delivery_delay_days", "avg_delay", 2),
        ],
    )
    return rows.orderBy(F.desc("total_revenue"), "department_name")


def supplier_best_worst(base: DataFrame) -> DataFrame:
    """Number of suppliers and the names with the highest and lowest on-time rate; the first name wins a tie."""
    rows = _by(base, ["department_name"], [rate("on_time_flag", "on_time_pct", 1)])
    name, value = F.col("department_name"), F.col("on_time_pct")
    return rows.agg(
        F.count(F.lit(1)).alias("total_suppliers"),
        F.min_by(name, F.struct(-value, name)).alias("best_supplier"),
        F.min_by(name, F.struct(value, name)).alias("worst_supplier"),
    )


# ── page 3: inventory and fulfillment ──


def fulfillment_cards(base: DataFrame) -> DataFrame:
    row = summarize(
        base,
        [],
        [
            rate("is_fulfilled", "fulfill", None),
            rate("is_cancelled", "cancel", None),
            quantity("quantity", "total_units"),
            mean("quantity", "avg_units", None),
        ],
    )
    status = {
        "fulfill": _good(F.col("fulfill") > 90),
        "cancel": _good(F.col("cancel") < 5),
        "total_units": F.lit("neutral"),
        "avg_units": F.lit("neutral"),
    }
    return _cards(row, status)


def units_by_category(base: DataFrame) -> DataFrame:
    rows = _by(base, ["category"], [quantity("quantity", "qty"), money("sales", "revenue", None)])
    return rows.orderBy(F.desc("qty"), "category")


def fulfillment_by_category(base: DataFrame) -> DataFrame:
    return _by(base, ["category"], [rate("is_fulfilled", "fulfill_pct", 1)]).orderBy("fulfill_pct", "category")


def monthly_fulfillment_trend(base: DataFrame) -> DataFrame:
    months = _by(base, ["year", "month"], [rate("is_fulfilled", "fulfill_pct"), rate("is_cancelled", "cancel_pct")])
    return _with_period(months)


def order_status_distribution(base: DataFrame) -> DataFrame:
    rows = _by(base, ["order_status"], [filled("order_id", "count"), money("sales", "revenue", None)])
    return rows.orderBy(F.desc("count"), "order_status")


# ── page 4: cost and risk ──


def cost_risk_cards(base: DataFrame) -> DataFrame:
    row = summarize(
        base,
        [],
        [
            money("sales", "total_revenue", None),
            money("profit", "total_profit", None),
            mean("profit_margin_pct", "avg_margin", None),
            money("revenue_at_risk", "rev_at_risk", None),
            ratio_or_zero("revenue_at_risk", "sales", "risk_pct"),
            mean("cost_per_order", "avg_cost", None),
        ],
    )
    status = {
        "total_revenue": F.lit("neutral"),
        "total_profit": _good(F.col("total_profit") > 0),
        "avg_margin": _good(F.col("avg_margin") > 15),
        "rev_at_risk": _good(F.col("risk_pct") <= 5),
        "risk_pct": _good(F.col("risk_pct") <= 5),
        "avg_cost": F.lit("neutral"),
    }
    return _cards(row, status)


def margin_by_category(base: DataFrame) -> DataFrame:
    return _by(base, ["category"], [mean("profit_margin_pct", "margin", None)]).orderBy(F.desc("margin"), "category")


def risk_by_market(base: DataFrame) -> DataFrame:
    rows = _by(
        base,
        ["market"],
        [
            money("revenue_at_risk", "at_risk", None),
            money("sales", "revenue", None),
            ratio("revenue_at_risk", "sales", "risk_pct", 100.0),
        ],
    )
    return rows.orderBy(F.desc("at_risk"), "market")


def cost_by_shipping(base: DataFrame) -> DataFrame:
    """Cost and margin per shipping mode, with the average cost as a ``$x,xxx`` label."""
    rows = _by(
        base,
        ["shipping_mode"],
        [
            mean("cost_per_order", "avg_cost", None),
            mean("profit_margin_pct", "avg_margin", None),
            filled("order_id", "orders"),
        ],
    )
    label = F.concat(F.lit("$"), F.format_number("avg_cost", 0))
    return rows.withColumn("cost_label", label).orderBy(F.desc("avg_cost"), "shipping_mode")


def monthly_margin_trend(base: DataFrame) -> DataFrame:
    """Margin per month and the mean of the monthly means; the window sees one row per month."""
    months = _by(base, ["year", "month"], [mean("profit_margin_pct", "margin", None)])
    # Summed in fixed-point, so that the mean does not depend on the order of the months.
    total = F.sum(F.col("margin").cast("decimal(28,12)")).over(Window.partitionBy()).cast("double")
    n = F.count("margin").over(Window.partitionBy()).cast("double")
    return _with_period(months.withColumn("mean_margin", round_half_away(F.try_divide(total, n), 6)))


# ── page 5: operations ──


def daily_order_volume(base: DataFrame) -> DataFrame:
    days = base.withColumn("date", F.to_date("order_date"))
    return _by(days, ["date"], [filled("order_id", "orders")]).orderBy("date")


def orders_by_weekday(base: DataFrame) -> DataFrame:
    """Seven rows, Monday first; 0 for a day without orders. Numeric day codes count from Sunday = 1."""
    if "order_dow" not in base.columns:
        days = base.withColumn("order_dow", day_name(F.col("order_date")))
    elif isinstance(base.schema["order_dow"].dataType, NumericType):
        from_sunday = F.array(*[F.lit(d) for d in (WEEKDAYS[-1], *WEEKDAYS[:-1])])
        days = base.withColumn("order_dow", F.get(from_sunday, F.col("order_dow").cast("int") - 1))
    else:
        days = base
    counts = _by(days, ["order_dow"], [filled("order_id", "orders")])
    week = base.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(d) for d in WEEKDAYS])).alias("_day", "order_dow"))
    rows = week.join(counts, "order_dow", "left").fillna(0, subset=["orders"])
    return rows.orderBy("_day").select("order_dow", "orders")


def revenue_by_quarter(base: DataFrame) -> DataFrame:
    rows = _by(base, ["year", "quarter"], [filled("order_id", "orders"), money("sales", "revenue", None)])
    label = F.concat(F.lit("Q"), F.col("quarter").cast("string"), F.lit(" "), F.col("year").cast("string"))
    return rows.withColumn("label", label).orderBy("year", "quarter")
