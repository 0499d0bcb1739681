"""Rollups of enriched order lines and their refreshed form over the star schema."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.measures import (
    Measure,
    distinct,
    filled,
    finish,
    fold,
    fold_through,
    mean,
    merge,
    money,
    rate,
    share_of_lines,
    summarize,
    units,
)

SUPPLIER_KEYS = ["department_id", "department_name"]
MONTH_KEYS = ["order_year", "order_month"]
REGION_KEYS = ["market", "order_region"]
MODE_KEYS = ["shipping_mode"]

SUPPLIER: list[Measure] = [
    filled("order_id", "total_orders"),
    money("sales", "total_revenue", None),
    money("profit", "total_profit", None),
    mean("delivery_delay_days", "avg_delay_days", None),
    mean("on_time_flag", "on_time_rate", None),
    mean("days_shipping_real", "avg_lead_time_days", None),
    mean("profit_margin_pct", "avg_profit_margin", None),
    units("is_cancelled", "total_cancelled"),
    units("is_fulfilled", "total_fulfilled"),
    money("revenue_at_risk", "total_revenue_at_risk", None),
    distinct("product_id", "distinct_products"),
    distinct("order_region", "regions_served"),
    share_of_lines("is_cancelled", "cancellation_rate"),
    share_of_lines("is_fulfilled", "fulfillment_rate"),
    rate("on_time_flag", "on_time_rate_pct"),
]
MONTHLY: list[Measure] = [
    filled("order_id", "total_orders"),
    money("sales", "total_revenue", None),
    money("profit", "total_profit", None),
    mean("delivery_delay_days", "avg_delay_days", None),
    mean("on_time_flag", "on_time_rate", None),
    mean("profit_margin_pct", "avg_profit_margin", None),
    units("is_cancelled", "cancelled_orders"),
    units("is_fulfilled", "fulfilled_orders"),
    units("perfect_order_flag", "perfect_orders"),
    money("revenue_at_risk", "revenue_at_risk", None),
    mean("cost_per_order", "avg_cost_per_order", None),
    share_of_lines("is_cancelled", "cancellation_rate_pct"),
    share_of_lines("is_fulfilled", "fulfillment_rate_pct"),
    share_of_lines("perfect_order_flag", "perfect_order_rate_pct"),
    rate("on_time_flag", "on_time_rate_pct"),
]
REGIONAL: list[Measure] = [
    filled("order_id", "total_orders"),
    money("sales", "total_revenue", None),
    money("profit", "total_profit", None),
    mean("on_time_flag", "on_time_rate", None),
    mean("delivery_delay_days", "avg_delay_days", None),
    money("revenue_at_risk", "revenue_at_risk", None),
    rate("on_time_flag", "on_time_rate_pct"),
]
SHIPPING: list[Measure] = [
    filled("order_id", "total_orders"),
    mean("days_shipping_real", "avg_actual_days", None),
    mean("delivery_delay_days", "avg_delay_days", None),
    mean("on_time_flag", "on_time_rate", None),
    money("sales", "total_revenue", None),
    rate("on_time_flag", "on_time_rate_pct"),
]
# The daily refresh publishes rounded figures.
MONTHLY_REFRESH: list[Measure] = [
    filled("order_id", "total_orders"),
    money("sales", "total_revenue"),
    money("profit", "total_profit"),
    mean("delivery_delay_days", "avg_delay_days"),
    rate("on_time_flag", "on_time_rate_pct"),
    mean("profit_margin_pct", "avg_profit_margin"),
    units("is_cancelled", "cancelled_orders"),
    units("is_fulfilled", "fulfilled_orders"),
    units("perfect_order_flag", "perfect_orders"),
    money("revenue_at_risk", "revenue_at_risk"),
    mean("cost_per_order", "avg_cost_per_order"),
]
REGIONAL_REFRESH: list[Measure] = [
    filled("order_id", "total_orders"),
    money("sales", "total_revenue"),
    money("profit", "total_profit"),
    rate("on_time_flag", "on_time_rate_pct"),
    mean("delivery_delay_days", "avg_delay_days"),
    money("revenue_at_risk", "revenue_at_risk"),
]


def rollup_supplier(orders: DataFrame) -> DataFrame:
    """Through figures by supplier and region and the supplier's products, so that its two distinct counts don't repeat the
    order lines."""
    return _supplier_from_cube(fold(orders, SUPPLIER_REGION_KEYS, _SUPPLIER_SUMS), supplier_product_pairs(orders))


def rollup_monthly(orders: DataFrame) -> DataFrame:
    return summarize(orders, MONTH_KEYS, MONTHLY).orderBy(*MONTH_KEYS)


def rollup_regional(orders: DataFrame) -> DataFrame:
    return summarize(orders, REGION_KEYS, REGIONAL).orderBy(F.desc("total_revenue"), *REGION_KEYS)


def rollup_shipping(orders: DataFrame) -> DataFrame:
    return summarize(orders, MODE_KEYS, SHIPPING).orderBy(F.desc("total_orders"), *MODE_KEYS)


def rollups(orders: DataFrame) -> dict[str, DataFrame]:
    """The four rollup tables from enriched order lines."""
    return {
        "kpi_monthly": rollup_monthly(orders),
        "kpi_regional": rollup_regional(orders),
        "kpi_shipping": rollup_shipping(orders),
        "supplier_metrics": rollup_supplier(orders),
    }


# ── rollups that are kept current batch by batch ──
#
# A cube of partial aggregates has one slice for each rollup, by its keys alone; the slice of suppliers is by region too, for
# the regions they serve. A slice folds to its few groups in every task, where one by all keys together would send nearly a
# row per line. Cubes of disjoint batches can be merged. So the fact is aggregated once when it arrives; a refresh reads
# cubes only.

SUPPLIER_REGION_KEYS = [*SUPPLIER_KEYS, "order_region"]
_SUPPLIER_SUMS = [m for m in SUPPLIER if m.mergeable]
_SLICES = {
    "monthly": (MONTH_KEYS, [*MONTHLY, *MONTHLY_REFRESH]),
    "regional": (REGION_KEYS, [*REGIONAL, *REGIONAL_REFRESH]),
    "shipping": (MODE_KEYS, SHIPPING),
    "supplier": (SUPPLIER_REGION_KEYS, _SUPPLIER_SUMS),
}


def rollup_cube(orders: DataFrame) -> DataFrame:
    """Partial aggregates of enriched order lines, by slice and its keys."""
    slices = [fold(orders, keys, measures).withColumn("slice", F.lit(name)) for name, (keys, measures) in _SLICES.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), slices)


def _slice(cube: DataFrame, name: str) -> DataFrame:
    return cube.where(F.col("slice") == name)


def supplier_product_pairs(orders: DataFrame) -> DataFrame:
    """The products of each supplier; with the cube, all that the supplier rollup needs."""
    return orders.select(*SUPPLIER_KEYS, "product_id").distinct()


def rollups_from_cube(cube: DataFrame, pairs: DataFrame) -> dict[str, DataFrame]:
    """The four rollup tables as on first load."""
    monthly, regional, shipping = (_slice(cube, n) for n in ("monthly", "regional", "shipping"))
    return {
        "kpi_monthly": finish(merge(monthly, MONTH_KEYS, MONTHLY), MONTH_KEYS, MONTHLY).orderBy(*MONTH_KEYS),
        "kpi_regional": finish(merge(regional, REGION_KEYS, REGIONAL), REGION_KEYS, REGIONAL).orderBy(
            F.desc("total_revenue"), *REGION_KEYS
        ),
        "kpi_shipping": finish(merge(shipping, MODE_KEYS, SHIPPING), MODE_KEYS, SHIPPING).orderBy(
            F.desc("total_orders"), *MODE_KEYS
        ),
        "supplier_metrics": _supplier_from_cube(_slice(cube, "supplier"), pairs),
    }


def refreshed_from_cube(cube: DataFrame, pairs: DataFrame) -> dict[str, DataFrame]:
    """The four rollup tables as published by the daily run: monthly and regional rounded."""
    dated = _slice(cube, "monthly").where("order_year IS NOT NULL")
    month_names = {"order_year": "year", "order_month": "month"}
    monthly = merge(dated, MONTH_KEYS, MONTHLY_REFRESH).withColumnsRenamed(month_names)
    placed = _slice(cube, "regional").dropna(subset=REGION_KEYS)
    return {
        **rollups_from_cube(cube, pairs),
        "kpi_monthly": finish_monthly(monthly),
        "kpi_regional": finish_regional(merge(placed, REGION_KEYS, REGIONAL_REFRESH)),
    }


def _supplier_from_cube(cube: DataFrame, pairs: DataFrame) -> DataFrame:
    sums = merge(cube, SUPPLIER_KEYS, _SUPPLIER_SUMS)
    regions = cube.groupBy(*SUPPLIER_KEYS).agg(F.count_distinct("order_region").alias("distinct_order_region"))
    products = pairs.groupBy(*SUPPLIER_KEYS).agg(F.count_distinct("product_id").alias("distinct_product_id"))
    # One row per supplier on each side; a missing department is a group like any other.
    for counts in (products, regions):
        renamed = counts.withColumnsRenamed({k: f"_{k}" for k in SUPPLIER_KEYS})
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in SUPPLIER_KEYS]
        sums = sums.join(renamed, same, "left").drop(*[f"_{k}" for k in SUPPLIER_KEYS])
    return finish(sums, SUPPLIER_KEYS, SUPPLIER).orderBy(*SUPPLIER_KEYS)


# ── rollups over the star schema ──


def refresh_monthly(star: Mapping[str, DataFrame]) -> DataFrame:
    """Monthly rollup through the date dimension; lines without a date drop out."""
    folded = fold_through(star["fact_orders"], "date_id", star["dim_date"], ["year", "month"], MONTHLY_REFRESH)
    return finish_monthly(folded)


def finish_monthly(folded: DataFrame) -> DataFrame:
    rows = finish(folded, {"year": "order_year", "month": "order_month"}, MONTHLY_REFRESH)
    return rows.orderBy(*MONTH_KEYS)


def refresh_regional(star: Mapping[str, DataFrame]) -> DataFrame:
    """Regional rollup through the geography dimension."""
    folded = fold_through(star["fact_orders"], "geo_id", star["dim_geography"], REGION_KEYS, REGIONAL_REFRESH)
    return finish_regional(folded)


def finish_regional(folded: DataFrame) -> DataFrame:
    return finish(folded, REGION_KEYS, REGIONAL_REFRESH).orderBy(F.desc("total_revenue"), *REGION_KEYS)
