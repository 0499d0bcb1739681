"""The ten business KPIs: 26 result tables, an executive summary and its vertical form.

Each KPI is a declaration: which dimension it looks through, what it groups by, which
measures it reports, how it is sorted and cut. ``kpi`` runs one; ``shared_parts`` and
``results_from_parts`` run all of them with one pass per grouping instead of one per KPI.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.measures import (
    Measure,
    complement_rate,
    distinct,
    finish,
    largest,
    lines,
    lines_where,
    mean,
    money,
    money_where,
    per_distinct,
    quantity,
    rate,
    ratio,
    smallest,
    units,
)
from orderloom.operators.parts import Grouping, folded, grouping_name, united


@dataclass(frozen=True)
class Kpi:
    """``keys`` are group columns, of dimension ``through`` when given; ``rename`` maps them to
    output names; a ``hidden`` key groups and sorts but is not reported."""

    measures: Sequence[Measure]
    keys: Sequence[str] = ()
    through: str | None = None
    order: Sequence[str] = ()
    limit: int | None = None
    rename: Mapping[str, str] | None = None
    hidden: Sequence[str] = ()


_CANCELLED_SALES = money_where("cancelled", lambda: F.col("is_cancelled") == 1, "sales", "revenue_lost")
_BY_REGION = {"through": "dim_geography", "keys": ("market", "order_region")}
_BY_CATEGORY = {"through": "dim_products", "keys": ("category",)}
_BY_SUPPLIER = {
    "through": "dim_suppliers",
    "keys": ("department_name",),
    "rename": {"department_name": "supplier"},
}

# A leading "-" sorts descending. Group keys break ties, so a cut is never arbitrary.
KPIS: dict[str, Kpi] = {
    "kpi01_on_time_overall": Kpi(
        [
            lines("total_orders"),
            units("on_time_flag", "on_time_orders"),
            rate("on_time_flag", "on_time_rate_pct"),
            complement_rate("on_time_flag", "late_rate_pct"),
        ]
    ),
    "kpi01_on_time_by_mode": Kpi(
        [lines("total_orders"), rate("on_time_flag", "on_time_rate_pct"), mean("delivery_delay_days", "avg_delay_days")],
        keys=("shipping_mode",),
        order=("-on_time_rate_pct",),
    ),
    "kpi01_on_time_by_year": Kpi(
        [lines("total_orders"), rate("on_time_flag", "on_time_rate_pct")],
        through="dim_date",
        keys=("year",),
    ),
    "kpi02_fulfillment_overall": Kpi(
        [
            lines("total_orders"),
            units("is_fulfilled", "fulfilled_orders"),
            rate("is_fulfilled", "fulfillment_rate_pct"),
            units("is_cancelled", "cancelled_orders"),
            rate("is_cancelled", "cancellation_rate_pct"),
        ]
    ),
    "kpi02_fulfillment_by_region": Kpi(
        [
            lines("total_orders"),
            rate("is_fulfilled", "fulfillment_rate_pct"),
            rate("is_cancelled", "cancellation_rate_pct"),
        ],
        **_BY_REGION,
        order=("-fulfillment_rate_pct",),
        limit=10,
    ),
    "kpi03_delay_overall": Kpi(
        [
            mean("delivery_delay_days", "avg_delay_days"),
            smallest("delivery_delay_days", "min_delay_days"),
            largest("delivery_delay_days", "max_delay_days"),
            lines_where("late", lambda: F.col("delivery_delay_days") > 0, "late_orders"),
            lines_where("early", lambda: F.col("delivery_delay_days") <= 0, "on_time_or_early"),
        ]
    ),
    "kpi03_delay_by_category": Kpi(
        [mean("delivery_delay_days", "avg_delay_days"), lines("total_orders"), rate("on_time_flag", "on_time_pct")],
        **_BY_CATEGORY,
        order=("-avg_delay_days",),
        limit=10,
    ),
    "kpi03_delay_by_month": Kpi(
        [mean("delivery_delay_days", "avg_delay_days"), lines("total_orders")],
        through="dim_date",
        keys=("year", "month", "month_name"),
    ),
    "kpi04_supplier_lead_time": Kpi(
        [
            mean("days_shipping_real", "avg_lead_time_days"),
            mean("days_shipping_scheduled", "avg_scheduled_days"),
            mean("delivery_delay_days", "avg_delay_days"),
            rate("on_time_flag", "on_time_rate_pct"),
            distinct("order_id", "total_orders"),
        ],
        **_BY_SUPPLIER,
        order=("-avg_lead_time_days",),
    ),
    "kpi05_inventory_by_product": Kpi(
        [
            quantity("quantity", "total_qty_sold"),
            distinct("order_id", "order_count"),
            money("sales", "total_revenue"),
            per_distinct("quantity", "order_id", "avg_qty_per_order"),
            ratio("sales", "cost_per_order", "turnover_proxy"),
        ],
        through="dim_products",
        keys=("category", "product_name"),
        order=("-total_qty_sold",),
        limit=15,
    ),
    "kpi05_inventory_by_category": Kpi(
        [
            quantity("quantity", "total_qty_sold"),
            money("sales", "total_revenue"),
            ratio("sales", "cost_per_order", "turnover_proxy"),
        ],
        **_BY_CATEGORY,
        order=("-turnover_proxy",),
    ),
    "kpi06_margin_overall": Kpi(
        [
            money("sales", "total_revenue"),
            money("profit", "total_profit"),
            mean("profit_margin_pct", "avg_margin_pct"),
            smallest("profit_margin_pct", "min_margin_pct"),
            largest("profit_margin_pct", "max_margin_pct"),
        ]
    ),
    "kpi06_margin_by_category": Kpi(
        [money("sales", "total_revenue"), money("profit", "total_profit"), mean("profit_margin_pct", "avg_margin_pct")],
        **_BY_CATEGORY,
        order=("-avg_margin_pct",),
    ),
    "kpi06_margin_by_segment": Kpi(
        [money("sales", "total_revenue"), money("profit", "total_profit"), mean("profit_margin_pct", "avg_margin_pct")],
        through="dim_customers",
        keys=("segment",),
        order=("-avg_margin_pct",),
    ),
    "kpi07_cost_overall": Kpi(
        [
            mean("cost_per_order", "avg_cost_per_order"),
            smallest("cost_per_order", "min_cost"),
            largest("cost_per_order", "max_cost"),
            money("cost_per_order", "total_cost"),
        ]
    ),
    "kpi07_cost_by_shipping": Kpi(
        [
            mean("cost_per_order", "avg_cost_per_order"),
            mean("sales", "avg_sales"),
            mean("profit_margin_pct", "avg_margin_pct"),
            lines("total_orders"),
        ],
        keys=("shipping_mode",),
        order=("-avg_cost_per_order",),
    ),
    "kpi07_cost_by_market": Kpi(
        [mean("cost_per_order", "avg_cost_per_order"), money("cost_per_order", "total_cost"), lines("total_orders")],
        through="dim_geography",
        keys=("market",),
        order=("-avg_cost_per_order",),
    ),
    "kpi08_cancellation_overall": Kpi(
        [
            lines("total_orders"),
            units("is_cancelled", "cancelled_orders"),
            rate("is_cancelled", "cancellation_rate_pct"),
            _CANCELLED_SALES,
        ]
    ),
    "kpi08_cancellation_by_region": Kpi(
        [
            lines("total_orders"),
            units("is_cancelled", "cancelled"),
            rate("is_cancelled", "cancellation_rate_pct"),
            _CANCELLED_SALES,
        ],
        **_BY_REGION,
        order=("-cancellation_rate_pct",),
        limit=10,
    ),
    "kpi08_cancellation_by_month": Kpi(
        [lines("total_orders"), rate("is_cancelled", "cancellation_rate_pct")],
        through="dim_date",
        keys=("year", "month", "month_name"),
        hidden=("month",),
    ),
    "kpi09_perfect_order_overall": Kpi(
        [
            lines("total_orders"),
            units("perfect_order_flag", "perfect_orders"),
            rate("perfect_order_flag", "perfect_order_rate_pct"),
            lines_where(
                "perfect",
                lambda: (F.col("on_time_flag") == 1) & (F.col("is_fulfilled") == 1) & (F.col("is_cancelled") == 0),
                "verified_perfect_orders",
            ),
        ]
    ),
    "kpi09_perfect_order_by_supplier": Kpi(
        [
            lines("total_orders"),
            rate("perfect_order_flag", "perfect_order_rate_pct"),
            rate("on_time_flag", "on_time_rate_pct"),
            rate("is_fulfilled", "fulfillment_rate_pct"),
        ],
        **_BY_SUPPLIER,
        order=("-perfect_order_rate_pct",),
    ),
    "kpi09_perfect_order_by_category": Kpi(
        [lines("total_orders"), rate("perfect_order_flag", "perfect_order_rate_pct")],
        **_BY_CATEGORY,
        order=("-perfect_order_rate_pct",),
    ),
    "kpi10_revenue_at_risk_overall": Kpi(
        [
            money("sales", "total_revenue"),
            money("revenue_at_risk", "total_revenue_at_risk"),
            ratio("revenue_at_risk", "sales", "risk_pct_of_revenue", 100.0),
            lines_where("at_risk", lambda: F.col("revenue_at_risk") > 0, "at_risk_orders"),
        ]
    ),
    "kpi10_revenue_at_risk_by_region": Kpi(
        [
            money("revenue_at_risk", "revenue_at_risk"),
            money("sales", "total_revenue"),
            ratio("revenue_at_risk", "sales", "risk_pct", 100.0),
        ],
        **_BY_REGION,
        order=("-revenue_at_risk",),
        limit=10,
    ),
    "kpi10_revenue_at_risk_by_category": Kpi(
        [
            money("revenue_at_risk", "revenue_at_risk"),
            money("sales", "total_revenue"),
            ratio("revenue_at_risk", "sales", "risk_pct", 100.0),
        ],
        **_BY_CATEGORY,
        order=("-revenue_at_risk",),
    ),
    "kpi_executive_summary": Kpi(
        [
            distinct("order_id", "total_orders"),
            money("sales", "total_revenue"),
            money("profit", "total_profit"),
            mean("profit_margin_pct", "avg_profit_margin_pct"),
            rate("on_time_flag", "on_time_delivery_rate"),
            rate("is_fulfilled", "fulfillment_rate"),
            rate("is_cancelled", "cancellation_rate"),
            rate("perfect_order_flag", "perfect_order_rate"),
            mean("delivery_delay_days", "avg_delivery_delay_days"),
            mean("cost_per_order", "avg_cost_per_order"),
            money("revenue_at_risk", "total_revenue_at_risk"),
            ratio("revenue_at_risk", "sales", "revenue_at_risk_pct", 100.0),
        ]
    ),
}

# Label of each figure of the executive summary.
SUMMARY_LABELS = {
    "total_orders": "Total Orders",
    "total_revenue": "Total Revenue ($)",
    "total_profit": "Total Profit ($)",
    "avg_profit_margin_pct": "Avg Profit Margin (%)",
    "on_time_delivery_rate": "On-Time Delivery Rate (%)",
    "fulfillment_rate": "Fulfillment Rate (%)",
    "cancellation_rate": "Cancellation Rate (%)",
    "perfect_order_rate": "Perfect Order Rate (%)",
    "avg_delivery_delay_days": "Avg Delivery Delay (days)",
    "avg_cost_per_order": "Avg Cost Per Order ($)",
    "total_revenue_at_risk": "Total Revenue At Risk ($)",
    "revenue_at_risk_pct": "Revenue At Risk (%)",
}


def kpi(star: Mapping[str, DataFrame], name: str) -> DataFrame:
    """One KPI result table by name."""
    spec = KPIS[name]
    return _present(spec, folded(star, spec.through, spec.keys, spec.measures))


#: What the KPIs need of a batch, by grouping.
GROUPINGS = united([Grouping(spec.through, tuple(spec.keys), tuple(spec.measures)) for spec in KPIS.values()])


def shared_parts(star: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """One table of partial aggregates per grouping, with all its KPIs need.

    KPIs that look through the same dimension by the same keys share one pass over the
    fact; so the nine overall tables cost one scan. Where the star holds the parts of its batches, those are merged
    and the fact is not read. The tables have as many rows as the grouping has groups.
    """
    return {name: folded(star, g.through, g.keys, g.measures) for name, g in GROUPINGS.items()}


def results_from_parts(parts: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All KPI result tables, read off the shared parts (as planned or as stored)."""
    return {name: _present(spec, parts[_grouping(spec)]) for name, spec in KPIS.items()}


def _grouping(spec: Kpi) -> str:
    return grouping_name(spec.through, spec.keys)


def summary_vertical(star: Mapping[str, DataFrame]) -> DataFrame:
    """The executive summary as (label, value) rows."""
    row = kpi(star, "kpi_executive_summary")
    figures = row.select(*[F.col(c).cast("double").alias(c) for c in SUMMARY_LABELS])
    labels = F.create_map(*[F.lit(x) for pair in SUMMARY_LABELS.items() for x in pair])
    return figures.unpivot([], list(SUMMARY_LABELS), "kpi", "value").select(labels[F.col("kpi")].alias("label"), "value")


def _present(spec: Kpi, folded: DataFrame) -> DataFrame:
    names = {k: (spec.rename or {}).get(k, k) for k in spec.keys}
    rows = finish(folded, names, spec.measures)
    if spec.keys:
        rows = rows.orderBy(*[_sort(c) for c in (*spec.order, *names.values())])
    if spec.limit:
        rows = rows.limit(spec.limit)
    return rows.drop(*spec.hidden)


def _sort(column: str) -> Column:
    return F.col(column[1:]).desc_nulls_last() if column.startswith("-") else F.col(column).asc_nulls_first()
