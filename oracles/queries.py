"""One SQL string per registered query."""

from __future__ import annotations

from oracles.base import (
    MAPPED,
    RAW,
    TITLED,
    avg,
    derived,
    mean,
    money,
    pct,
    quotient,
    r,
    text,
    title,
    total,
    units,
    with_cleaned,
    with_lines,
    with_raw,
    with_star,
)

ORACLES: dict[str, str] = {}

LINE = "order_id, order_item_id"

# ── derived columns ──

for _name, _column in {
    "drv_delivery_delay": "delivery_delay_days",
    "drv_on_time": "on_time_flag",
    "drv_profit_margin": "CAST(profit_margin_pct AS DOUBLE) AS profit_margin_pct",
    "drv_cancelled": "is_cancelled",
    "drv_fulfilled": "is_fulfilled",
    "drv_revenue_at_risk": "CAST(revenue_at_risk AS DOUBLE) AS revenue_at_risk",
    "drv_cost_per_order": "CAST(cost_per_order AS DOUBLE) AS cost_per_order",
    "drv_perfect_order": "perfect_order_flag",
    "drv_processing_days": "processing_days",
    "drv_order_week": "order_week",
}.items():
    ORACLES[_name] = with_lines(f"SELECT {LINE}, {_column} FROM lines")

ORACLES["drv_summary"] = with_lines(f"""
SELECT {avg('delivery_delay_days')} AS mean_delay_days, {pct('on_time_flag', 1)} AS on_time_pct,
       {avg('profit_margin_pct')} AS mean_margin_pct, {pct('is_cancelled', 1)} AS cancelled_pct,
       {pct('is_fulfilled', 1)} AS fulfilled_pct, {money('revenue_at_risk')} AS total_revenue_at_risk,
       {avg('cost_per_order')} AS mean_cost_per_order
FROM lines""")


def _doubles(columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns.split())


ORDER_ROW = f"""{LINE}, customer_id, product_id, {text('order_date')} AS order_date, {text('ship_date')} AS ship_date,
       order_year, order_month, order_quarter, order_dow, order_status, shipping_mode, delivery_status,
       late_delivery_risk, days_shipping_real, days_shipping_scheduled, delivery_delay_days, on_time_flag,
       {_doubles('sales')}, quantity,
       {_doubles('discount discount_rate unit_price profit_ratio profit item_total profit_margin_pct')},
       is_cancelled, is_fulfilled, {_doubles('revenue_at_risk cost_per_order')},
       market, order_region, order_country, order_city, order_state, payment_type, department_id, department_name"""
ENRICHED_ROW = f"{ORDER_ROW}, perfect_order_flag, processing_days, order_week"
CUSTOMER_ROW = "customer_id, first_name, last_name, email, segment, customer_city, customer_state, customer_country, zipcode"
PRODUCT_ROW = (
    "product_id, product_name, category, category_id, CAST(product_price AS DOUBLE) AS product_price, "
    "product_status, department_id, department_name"
)
ORACLES["enrich_orders"] = with_lines(f"SELECT {ENRICHED_ROW} FROM lines")

# ── star schema ──

ORACLES["dim_customers"] = with_star(f"SELECT {CUSTOMER_ROW} FROM dim_customers")
ORACLES["dim_products"] = with_star(f"SELECT {PRODUCT_ROW} FROM dim_products")
ORACLES["dim_suppliers"] = with_star("SELECT supplier_id, department_id, department_name FROM dim_suppliers")
ORACLES["dim_date"] = with_star("""
SELECT date_id, strftime(date, '%Y-%m-%d') AS date, year, month, month_name, quarter, week, day_of_week, is_weekend
FROM dim_date""")
ORACLES["dim_geography"] = with_star("SELECT * FROM dim_geography")
ORACLES["fact_date_key"] = f"""WITH {MAPPED},{RAW}
SELECT {LINE},
       CAST(strftime(try_strptime(order_date, '%-m/%-d/%Y %-H:%M'), '%Y%m%d') AS INTEGER) AS date_id
FROM raw"""
ORACLES["fact_supplier_key"] = with_star(f"SELECT {LINE}, supplier_id FROM fact")
ORACLES["fact_geo_key"] = with_star(f"SELECT {LINE}, geo_id FROM fact")
FACT_ROW = f"""{LINE}, customer_id, product_id, supplier_id, date_id, geo_id,
       {text('order_date')} AS order_date, {text('ship_date')} AS ship_date, order_status, shipping_mode,
       delivery_status, late_delivery_risk, payment_type, days_shipping_real, days_shipping_scheduled,
       delivery_delay_days, processing_days, on_time_flag, is_cancelled, is_fulfilled, perfect_order_flag,
       {_doubles('sales')}, quantity,
       {_doubles('discount discount_rate unit_price profit_ratio profit item_total profit_margin_pct')},
       {_doubles('cost_per_order revenue_at_risk')}"""
ORACLES["fact_orders"] = with_star(f"SELECT {FACT_ROW} FROM fact")
ORACLES["fact_coerce_types"] = with_lines(f"""
SELECT {LINE},
       CASE WHEN order_id % 89 = 0 THEN 0 ELSE on_time_flag END AS on_time_flag,
       CASE WHEN l_linenumber = 3 THEN 0 ELSE is_cancelled END AS is_cancelled,
       is_fulfilled, perfect_order_flag, late_delivery_risk,
       CASE WHEN order_id % 97 = 0 THEN 0e0 ELSE CAST(sales AS DOUBLE) END AS sales,
       CASE WHEN l_linenumber = 7 THEN 0e0 ELSE CAST(profit AS DOUBLE) END AS profit,
       {_doubles('discount profit_margin_pct cost_per_order revenue_at_risk item_total')}
FROM lines""")
ORACLES["star_join"] = with_star(f"""
SELECT {FACT_ROW}, year, month, month_name, quarter, market, order_region, order_country, segment, category,
       product_name, department_name
FROM report""")
ORACLES["supplier_products"] = with_lines("""
SELECT department_id, department_name, product_id, order_region, market
FROM (SELECT *, row_number() OVER (PARTITION BY department_id, product_id
        ORDER BY order_item_id, department_name, order_region, market) AS rn FROM lines)
WHERE rn = 1""")

# ── rollups ──

_SHARE = "CAST(SUM({0}) AS DOUBLE) / CAST(COUNT(order_id) AS DOUBLE) * 100e0"


def share(flag: str) -> str:
    return r(_SHARE.format(flag), 2)


SUPPLIER_ROLLUP = f"""
SELECT department_id, department_name, COUNT(order_id) AS total_orders, {total('sales')} AS total_revenue,
       {total('profit')} AS total_profit, {mean('delivery_delay_days')} AS avg_delay_days,
       {mean('on_time_flag')} AS on_time_rate, {mean('days_shipping_real')} AS avg_lead_time_days,
       {mean('profit_margin_pct')} AS avg_profit_margin, {units('is_cancelled')} AS total_cancelled,
       {units('is_fulfilled')} AS total_fulfilled, {total('revenue_at_risk')} AS total_revenue_at_risk,
       COUNT(DISTINCT product_id) AS distinct_products, COUNT(DISTINCT order_region) AS regions_served,
       {share('is_cancelled')} AS cancellation_rate, {share('is_fulfilled')} AS fulfillment_rate,
       {pct('on_time_flag')} AS on_time_rate_pct
FROM lines GROUP BY department_id, department_name"""
MONTHLY_ROLLUP = f"""
SELECT order_year, order_month, COUNT(order_id) AS total_orders, {total('sales')} AS total_revenue,
       {total('profit')} AS total_profit, {mean('delivery_delay_days')} AS avg_delay_days,
       {mean('on_time_flag')} AS on_time_rate, {mean('profit_margin_pct')} AS avg_profit_margin,
       {units('is_cancelled')} AS cancelled_orders, {units('is_fulfilled')} AS fulfilled_orders,
       {units('perfect_order_flag')} AS perfect_orders, {total('revenue_at_risk')} AS revenue_at_risk,
       {mean('cost_per_order')} AS avg_cost_per_order,
       {share('is_cancelled')} AS cancellation_rate_pct, {share('is_fulfilled')} AS fulfillment_rate_pct,
       {share('perfect_order_flag')} AS perfect_order_rate_pct, {pct('on_time_flag')} AS on_time_rate_pct
FROM lines GROUP BY order_year, order_month"""
REGIONAL_ROLLUP = f"""
SELECT market, order_region, COUNT(order_id) AS total_orders, {total('sales')} AS total_revenue,
       {total('profit')} AS total_profit, {mean('on_time_flag')} AS on_time_rate,
       {mean('delivery_delay_days')} AS avg_delay_days, {total('revenue_at_risk')} AS revenue_at_risk,
       {pct('on_time_flag')} AS on_time_rate_pct
FROM lines GROUP BY market, order_region"""
SHIPPING_ROLLUP = f"""
SELECT shipping_mode, COUNT(order_id) AS total_orders, {mean('days_shipping_real')} AS avg_actual_days,
       {mean('delivery_delay_days')} AS avg_delay_days, {mean('on_time_flag')} AS on_time_rate,
       {total('sales')} AS total_revenue, {pct('on_time_flag')} AS on_time_rate_pct
FROM lines GROUP BY shipping_mode"""


def refresh_monthly(source: str) -> str:
    return f"""
SELECT CAST(year(order_date) AS INTEGER) AS order_year, CAST(month(order_date) AS INTEGER) AS order_month,
       COUNT(order_id) AS total_orders, {money('sales')} AS total_revenue, {money('profit')} AS total_profit,
       {avg('delivery_delay_days')} AS avg_delay_days, {pct('on_time_flag')} AS on_time_rate_pct,
       {avg('profit_margin_pct')} AS avg_profit_margin, {units('is_cancelled')} AS cancelled_orders,
       {units('is_fulfilled')} AS fulfilled_orders, {units('perfect_order_flag')} AS perfect_orders,
       {money('revenue_at_risk')} AS revenue_at_risk, {avg('cost_per_order')} AS avg_cost_per_order
FROM {source} GROUP BY 1, 2"""


def refresh_regional(source: str) -> str:
    return f"""
SELECT market, order_region, COUNT(order_id) AS total_orders, {money('sales')} AS total_revenue,
       {money('profit')} AS total_profit, {pct('on_time_flag')} AS on_time_rate_pct,
       {avg('delivery_delay_days')} AS avg_delay_days, {money('revenue_at_risk')} AS revenue_at_risk
FROM {source} GROUP BY market, order_region"""


ORACLES["rollup_supplier"] = with_lines(SUPPLIER_ROLLUP)
ORACLES["rollup_monthly"] = with_lines(MONTHLY_ROLLUP)
ORACLES["rollup_regional"] = with_lines(REGIONAL_ROLLUP)
ORACLES["rollup_shipping"] = with_lines(SHIPPING_ROLLUP)
ORACLES["refresh_monthly"] = with_star(refresh_monthly("report"))
ORACLES["refresh_regional"] = with_star(refresh_regional("report"))

# ── KPIs ──


def _kpi(name: str, select: str, group: str = "", order: str = "", limit: int = 0) -> None:
    sql = f"SELECT {select}\nFROM report"
    if group:
        sql += f"\nGROUP BY {group}"
    if limit:
        sql += f"\nORDER BY {order}\nLIMIT {limit}"
    ORACLES[name] = with_star(sql)


_kpi(
    "kpi01_on_time_overall",
    f"COUNT(*) AS total_orders, {units('on_time_flag')} AS on_time_orders, {pct('on_time_flag')} AS on_time_rate_pct, "
    + r(f"(1e0 - {mean('on_time_flag')}) * 100e0", 2)
    + " AS late_rate_pct",
)
_kpi(
    "kpi01_on_time_by_mode",
    f"shipping_mode, COUNT(*) AS total_orders, {pct('on_time_flag')} AS on_time_rate_pct, "
    f"{avg('delivery_delay_days')} AS avg_delay_days",
    "shipping_mode",
)
_kpi("kpi01_on_time_by_year", f"year, COUNT(*) AS total_orders, {pct('on_time_flag')} AS on_time_rate_pct", "year")
_kpi(
    "kpi02_fulfillment_overall",
    f"COUNT(*) AS total_orders, {units('is_fulfilled')} AS fulfilled_orders, {pct('is_fulfilled')} AS "
    f"fulfillment_rate_pct, {units('is_cancelled')} AS cancelled_orders, {pct('is_cancelled')} AS cancellation_rate_pct",
)
_kpi(
    "kpi02_fulfillment_by_region",
    f"market, order_region, COUNT(*) AS total_orders, {pct('is_fulfilled')} AS fulfillment_rate_pct, "
    f"{pct('is_cancelled')} AS cancellation_rate_pct",
    "market, order_region",
    "fulfillment_rate_pct DESC, market, order_region",
    10,
)
_kpi(
    "kpi03_delay_overall",
    f"{avg('delivery_delay_days')} AS avg_delay_days, CAST(MIN(delivery_delay_days) AS DOUBLE) AS min_delay_days, "
    "CAST(MAX(delivery_delay_days) AS DOUBLE) AS max_delay_days, "
    "CAST(SUM(CASE WHEN delivery_delay_days > 0 THEN 1 ELSE 0 END) AS BIGINT) AS late_orders, "
    "CAST(SUM(CASE WHEN delivery_delay_days <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS on_time_or_early",
)
_kpi(
    "kpi03_delay_by_category",
    f"category, {avg('delivery_delay_days')} AS avg_delay_days, COUNT(*) AS total_orders, "
    f"{pct('on_time_flag')} AS on_time_pct",
    "category",
    "avg_delay_days DESC, category",
    10,
)
_kpi(
    "kpi03_delay_by_month",
    f"year, month, month_name, {avg('delivery_delay_days')} AS avg_delay_days, COUNT(*) AS total_orders",
    "year, month, month_name",
)
_kpi(
    "kpi04_supplier_lead_time",
    f"department_name AS supplier, {avg('days_shipping_real')} AS avg_lead_time_days, "
    f"{avg('days_shipping_scheduled')} AS avg_scheduled_days, {avg('delivery_delay_days')} AS avg_delay_days, "
    f"{pct('on_time_flag')} AS on_time_rate_pct, COUNT(DISTINCT order_id) AS total_orders",
    "department_name",
)
_kpi(
    "kpi05_inventory_by_product",
    f"category, product_name, {total('quantity')} AS total_qty_sold, COUNT(DISTINCT order_id) AS order_count, "
    f"{money('sales')} AS total_revenue, "
    + r("CAST(SUM(quantity) AS DOUBLE) / CAST(COUNT(DISTINCT order_id) AS DOUBLE)", 2)
    + f" AS avg_qty_per_order, {r(quotient('sales', 'cost_per_order'), 2)} AS turnover_proxy",
    "category, product_name",
    "total_qty_sold DESC, category, product_name",
    15,
)
_kpi(
    "kpi05_inventory_by_category",
    f"category, {total('quantity')} AS total_qty_sold, {money('sales')} AS total_revenue, "
    f"{r(quotient('sales', 'cost_per_order'), 2)} AS turnover_proxy",
    "category",
)
_MARGIN = (
    f"{money('sales')} AS total_revenue, {money('profit')} AS total_profit, {avg('profit_margin_pct')} AS avg_margin_pct"
)
_kpi(
    "kpi06_margin_overall",
    f"{_MARGIN}, CAST(MIN(profit_margin_pct) AS DOUBLE) AS min_margin_pct, "
    "CAST(MAX(profit_margin_pct) AS DOUBLE) AS max_margin_pct",
)
_kpi("kpi06_margin_by_category", f"category, {_MARGIN}", "category")
_kpi("kpi06_margin_by_segment", f"segment, {_MARGIN}", "segment")
_kpi(
    "kpi07_cost_overall",
    f"{avg('cost_per_order')} AS avg_cost_per_order, CAST(ROUND(MIN(cost_per_order), 2) AS DOUBLE) AS min_cost, "
    f"CAST(ROUND(MAX(cost_per_order), 2) AS DOUBLE) AS max_cost, {money('cost_per_order')} AS total_cost",
)
_kpi(
    "kpi07_cost_by_shipping",
    f"shipping_mode, {avg('cost_per_order')} AS avg_cost_per_order, {avg('sales')} AS avg_sales, "
    f"{avg('profit_margin_pct')} AS avg_margin_pct, COUNT(*) AS total_orders",
    "shipping_mode",
)
_kpi(
    "kpi07_cost_by_market",
    f"market, {avg('cost_per_order')} AS avg_cost_per_order, {money('cost_per_order')} AS total_cost, "
    "COUNT(*) AS total_orders",
    "market",
)
_LOST = "CAST(ROUND(SUM(CASE WHEN is_cancelled = 1 THEN sales ELSE 0 END), 2) AS DOUBLE) AS revenue_lost"
_kpi(
    "kpi08_cancellation_overall",
    f"COUNT(*) AS total_orders, {units('is_cancelled')} AS cancelled_orders, "
    f"{pct('is_cancelled')} AS cancellation_rate_pct, {_LOST}",
)
_kpi(
    "kpi08_cancellation_by_region",
    f"market, order_region, COUNT(*) AS total_orders, {units('is_cancelled')} AS cancelled, "
    f"{pct('is_cancelled')} AS cancellation_rate_pct, {_LOST}",
    "market, order_region",
    "cancellation_rate_pct DESC, market, order_region",
    10,
)
_kpi(
    "kpi08_cancellation_by_month",
    f"year, month_name, COUNT(*) AS total_orders, {pct('is_cancelled')} AS cancellation_rate_pct",
    "year, month_name, month",
)
_kpi(
    "kpi09_perfect_order_overall",
    f"COUNT(*) AS total_orders, {units('perfect_order_flag')} AS perfect_orders, "
    f"{pct('perfect_order_flag')} AS perfect_order_rate_pct, "
    "CAST(SUM(CASE WHEN on_time_flag = 1 AND is_fulfilled = 1 AND is_cancelled = 0 THEN 1 ELSE 0 END) AS BIGINT) "
    "AS verified_perfect_orders",
)
_kpi(
    "kpi09_perfect_order_by_supplier",
    f"department_name AS supplier, COUNT(*) AS total_orders, {pct('perfect_order_flag')} AS perfect_order_rate_pct, "
    f"{pct('on_time_flag')} AS on_time_rate_pct, {pct('is_fulfilled')} AS fulfillment_rate_pct",
    "department_name",
)
_kpi(
    "kpi09_perfect_order_by_category",
    f"category, COUNT(*) AS total_orders, {pct('perfect_order_flag')} AS perfect_order_rate_pct",
    "category",
)
_RISK_PCT = r(quotient("revenue_at_risk", "sales", " * 100e0"), 2)
_kpi(
    "kpi10_revenue_at_risk_overall",
    f"{money('sales')} AS total_revenue, {money('revenue_at_risk')} AS total_revenue_at_risk, "
    f"{_RISK_PCT} AS risk_pct_of_revenue, COUNT(CASE WHEN revenue_at_risk > 0 THEN 1 END) AS at_risk_orders",
)
_RISK = f"{money('revenue_at_risk')} AS revenue_at_risk, {money('sales')} AS total_revenue, {_RISK_PCT} AS risk_pct"
_kpi(
    "kpi10_revenue_at_risk_by_region",
    f"market, order_region, {_RISK}",
    "market, order_region",
    # the alias of the sum, not the column
    f"{money('revenue_at_risk')} DESC, market, order_region",
    10,
)
_kpi("kpi10_revenue_at_risk_by_category", f"category, {_RISK}", "category")
SUMMARY = {
    "total_orders": ("COUNT(DISTINCT order_id)", "Total Orders"),
    "total_revenue": (money("sales"), "Total Revenue ($)"),
    "total_profit": (money("profit"), "Total Profit ($)"),
    "avg_profit_margin_pct": (avg("profit_margin_pct"), "Avg Profit Margin (%)"),
    "on_time_delivery_rate": (pct("on_time_flag"), "On-Time Delivery Rate (%)"),
    "fulfillment_rate": (pct("is_fulfilled"), "Fulfillment Rate (%)"),
    "cancellation_rate": (pct("is_cancelled"), "Cancellation Rate (%)"),
    "perfect_order_rate": (pct("perfect_order_flag"), "Perfect Order Rate (%)"),
    "avg_delivery_delay_days": (avg("delivery_delay_days"), "Avg Delivery Delay (days)"),
    "avg_cost_per_order": (avg("cost_per_order"), "Avg Cost Per Order ($)"),
    "total_revenue_at_risk": (money("revenue_at_risk"), "Total Revenue At Risk ($)"),
    "revenue_at_risk_pct": (_RISK_PCT, "Revenue At Risk (%)"),
}
_kpi("kpi_executive_summary", ", ".join(f"{x} AS {c}" for c, (x, _) in SUMMARY.items()))
ORACLES["kpi_summary_vertical"] = with_star(
    "\nUNION ALL\n".join(
        f"SELECT '{label}' AS label, CAST({x} AS DOUBLE) AS value FROM report" for x, label in SUMMARY.values()
    )
)

# ── warehouse checks ──

ORACLES["chk_totals"] = with_star(f"""
SELECT {money('sales')} AS total_revenue, {money('profit')} AS total_profit, {avg('profit_margin_pct')} AS avg_margin_pct,
       COUNT(DISTINCT order_id) AS total_orders, COUNT(DISTINCT customer_id) AS total_customers
FROM fact""")
ORACLES["chk_delivery_status_share"] = with_star(f"""
SELECT delivery_status, COUNT(*) AS order_count,
       {r('CAST(COUNT(*) AS DOUBLE) * 100e0 / CAST(SUM(COUNT(*)) OVER () AS DOUBLE)', 2)} AS pct
FROM fact GROUP BY delivery_status""")
ORACLES["chk_revenue_by_market"] = with_star(f"""
SELECT market, {money('sales')} AS total_revenue, {avg('profit_margin_pct')} AS avg_margin,
       COUNT(DISTINCT order_id) AS total_orders
FROM report GROUP BY market""")
ORACLES["chk_top_categories"] = with_star(f"""
SELECT category, {money('sales')} AS total_revenue, {money('profit')} AS total_profit, COUNT(*) AS order_lines
FROM report GROUP BY category ORDER BY total_revenue DESC, category LIMIT 5""")
ORACLES["chk_segment_performance"] = with_star(f"""
SELECT segment, COUNT(DISTINCT order_id) AS total_orders, {money('sales')} AS total_revenue,
       {avg('profit_margin_pct')} AS avg_margin_pct
FROM report GROUP BY segment""")
ORACLES["chk_yearly_summary"] = with_star(f"""
SELECT year, COUNT(DISTINCT order_id) AS total_orders, {money('sales')} AS total_revenue,
       {pct('on_time_flag')} AS on_time_rate_pct, {avg('profit_margin_pct')} AS avg_margin_pct,
       {money('revenue_at_risk')} AS revenue_at_risk
FROM report GROUP BY year""")
ORACLES["chk_supplier_summary"] = with_lines(f"""
SELECT department_name, total_orders, {r('total_revenue', 2)} AS total_revenue,
       {r('on_time_rate_pct', 2)} AS on_time_rate_pct, {r('fulfillment_rate', 2)} AS fulfillment_rate_pct,
       {r('cancellation_rate', 2)} AS cancellation_rate_pct, {r('avg_lead_time_days', 2)} AS avg_lead_time_days
FROM ({SUPPLIER_ROLLUP}) s
ORDER BY {r('s.total_revenue', 2)} DESC, department_name LIMIT 8""")

# ── report pages ──

YEARS, MARKETS, CATEGORIES = (1996, 1997, 1998), ("ASIA", "EUROPE"), ("LARGE", "PROMO", "SMALL")


def _in(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


ORACLES["report_filter"] = with_star(f"""
SELECT {FACT_ROW}, year, market, segment, category FROM report
WHERE year IN ({_in(YEARS)}) AND market IN ({_in(MARKETS)}) AND segment IS NOT NULL
  AND category IN ({_in(CATEGORIES)})""")
ORACLES["filter_options"] = with_star(
    "\nUNION ALL\n".join(
        f"SELECT DISTINCT '{c}' AS filter, CAST({c} AS VARCHAR) AS value FROM report WHERE {c} IS NOT NULL"
        for c in ("year", "market", "segment", "category")
    )
)
PAGE = "FROM report WHERE year IS NOT NULL AND market IS NOT NULL AND segment IS NOT NULL AND category IS NOT NULL"


def _rate(c: str) -> str:
    return mean(c, " * 100e0")


RISK_PCT_RAW = (
    "CASE WHEN SUM(sales) > 0 THEN CAST(SUM(revenue_at_risk) AS DOUBLE) / CAST(SUM(sales) AS DOUBLE) * 100e0 "
    "ELSE 0e0 END"
)
CARDS = f"""
SELECT COUNT(DISTINCT order_id) AS total_orders, {total('sales')} AS total_revenue, {total('profit')} AS total_profit,
       {mean('profit_margin_pct')} AS avg_margin, {_rate('on_time_flag')} AS on_time, {_rate('is_fulfilled')} AS fulfill,
       {_rate('is_cancelled')} AS cancel, {_rate('perfect_order_flag')} AS perfect,
       {mean('delivery_delay_days')} AS avg_delay, {mean('cost_per_order')} AS avg_cost,
       {total('revenue_at_risk')} AS rev_at_risk, {RISK_PCT_RAW} AS risk_pct,
       {total('quantity')} AS total_units, {mean('quantity')} AS avg_units
{PAGE}"""
CARD_STATUS = {
    "total_orders": "'neutral'",
    "total_revenue": "'neutral'",
    "total_profit": "CASE WHEN total_profit > 0 THEN 'good' ELSE 'bad' END",
    "avg_margin": "CASE WHEN avg_margin > 15 THEN 'good' ELSE 'bad' END",
    "on_time": "CASE WHEN on_time > 70 THEN 'good' ELSE 'bad' END",
    "fulfill": "CASE WHEN fulfill > 90 THEN 'good' ELSE 'bad' END",
    "cancel": "CASE WHEN cancel < 5 THEN 'good' ELSE 'bad' END",
    "perfect": "CASE WHEN perfect > 70 THEN 'good' ELSE 'bad' END",
    "avg_delay": "CASE WHEN avg_delay <= 0 THEN 'good' ELSE 'bad' END",
    "avg_cost": "'neutral'",
    "rev_at_risk": "CASE WHEN risk_pct > 5 THEN 'bad' ELSE 'good' END",
    "risk_pct": "CASE WHEN risk_pct > 5 THEN 'bad' ELSE 'good' END",
    "total_units": "'neutral'",
    "avg_units": "'neutral'",
}


def _cards(*names: str) -> str:
    rows = "\nUNION ALL\n".join(
        f"SELECT '{n}' AS card, CAST({n} AS DOUBLE) AS value, {CARD_STATUS[n]} AS status FROM cards" for n in names
    )
    return with_star(f", cards AS ({CARDS})\n{rows}")


ORACLES["exec_cards"] = with_star(f"SELECT * EXCLUDE (total_units, avg_units) FROM ({CARDS})")
ORACLES["exec_card_status"] = _cards(*[n for n in CARD_STATUS if n not in ("total_units", "avg_units")])
ORACLES["fulfillment_cards"] = _cards("fulfill", "cancel", "total_units", "avg_units")
ORACLES["cost_risk_cards"] = _cards("total_revenue", "total_profit", "avg_margin", "rev_at_risk", "risk_pct", "avg_cost")
PERIOD = "printf('%d-%02d', year, month) AS period"
ORACLES["monthly_revenue_profit"] = with_star(f"""
SELECT year, month, {total('sales')} AS revenue, {total('profit')} AS profit, {PERIOD} {PAGE} GROUP BY year, month""")
ORACLES["revenue_by_market"] = with_star(f"""
SELECT market, revenue, {r('revenue / SUM(revenue) OVER () * 100e0', 6)} AS share_pct
FROM (SELECT market, {total('sales')} AS revenue {PAGE} GROUP BY market)""")
ORACLES["delivery_status_counts"] = with_star(f"""
SELECT delivery_status, COUNT(*) AS count {PAGE} GROUP BY delivery_status""")
SUPPLIER_TABLE = f"""
SELECT department_name, COUNT(order_id) AS total_orders, {money('sales', 0)} AS total_revenue,
       {pct('on_time_flag', 1)} AS on_time_pct, {pct('is_fulfilled', 1)} AS fulfill_pct,
       {pct('is_cancelled', 1)} AS cancel_pct, {pct('perfect_order_flag', 1)} AS perfect_pct,
       {avg('days_shipping_real', 1)} AS avg_lead_time, {avg('delivery_delay_days')} AS avg_delay
{PAGE} GROUP BY department_name"""
ORACLES["supplier_table"] = with_star(SUPPLIER_TABLE)
ORACLES["supplier_best_worst"] = with_star(f"""
, t AS ({SUPPLIER_TABLE})
SELECT (SELECT COUNT(*) FROM t) AS total_suppliers,
       (SELECT department_name FROM t ORDER BY on_time_pct DESC, department_name LIMIT 1) AS best_supplier,
       (SELECT department_name FROM t ORDER BY on_time_pct, department_name LIMIT 1) AS worst_supplier""")
ORACLES["units_by_category"] = with_star(f"""
SELECT category, {total('quantity')} AS qty, {total('sales')} AS revenue {PAGE} GROUP BY category""")
ORACLES["fulfillment_by_category"] = with_star(f"""
SELECT category, {pct('is_fulfilled', 1)} AS fulfill_pct {PAGE} GROUP BY category""")
ORACLES["monthly_fulfillment_trend"] = with_star(f"""
SELECT year, month, {pct('is_fulfilled')} AS fulfill_pct, {pct('is_cancelled')} AS cancel_pct, {PERIOD}
{PAGE} GROUP BY year, month""")
ORACLES["order_status_distribution"] = with_star(f"""
SELECT order_status, COUNT(order_id) AS count, {total('sales')} AS revenue {PAGE} GROUP BY order_status""")
ORACLES["margin_by_category"] = with_star(f"""
SELECT category, {mean('profit_margin_pct')} AS margin {PAGE} GROUP BY category""")
ORACLES["risk_by_market"] = with_star(f"""
SELECT market, {total('revenue_at_risk')} AS at_risk, {total('sales')} AS revenue, {_RISK_PCT} AS risk_pct
{PAGE} GROUP BY market""")
ORACLES["cost_by_shipping"] = with_star(f"""
SELECT shipping_mode, {mean('cost_per_order')} AS avg_cost, {mean('profit_margin_pct')} AS avg_margin,
       COUNT(order_id) AS orders, '$' || format('{{:,}}', CAST(ROUND({mean('cost_per_order')}) AS BIGINT)) AS cost_label
{PAGE} GROUP BY shipping_mode""")
ORACLES["monthly_margin_trend"] = with_star(f"""
SELECT year, month, margin, {r('CAST(SUM(CAST(margin AS DECIMAL(28,12))) OVER () AS DOUBLE) / COUNT(margin) OVER ()', 6)}
       AS mean_margin, {PERIOD}
FROM (SELECT year, month, {mean('profit_margin_pct')} AS margin {PAGE} GROUP BY year, month)""")
ORACLES["daily_order_volume"] = with_star(f"""
SELECT strftime(order_date, '%Y-%m-%d') AS date, COUNT(order_id) AS orders {PAGE} GROUP BY 1""")
ORACLES["orders_by_weekday"] = with_star(f"""
, days AS (SELECT dayname(order_date) AS order_dow, COUNT(order_id) AS orders {PAGE} GROUP BY 1)
SELECT w.order_dow, COALESCE(orders, 0) AS orders
FROM (VALUES ('Monday'), ('Tuesday'), ('Wednesday'), ('Thursday'), ('Friday'), ('Saturday'), ('Sunday')) w(order_dow)
LEFT JOIN days USING (order_dow)""")
ORACLES["revenue_by_quarter"] = with_star(f"""
SELECT year, quarter, COUNT(order_id) AS orders, {total('sales')} AS revenue,
       'Q' || CAST(quarter AS VARCHAR) || ' ' || CAST(year AS VARCHAR) AS label
{PAGE} GROUP BY year, quarter""")

# ── data quality ──

CHECKS = {
    "total_records": ("COUNT(*)", "CASE WHEN value > 0 THEN 'good' ELSE 'bad' END"),
    "null_order_id": ("COUNT(*) FILTER (order_id IS NULL)", "CASE WHEN value = 0 THEN 'good' ELSE 'bad' END"),
    "null_sales": ("COUNT(*) FILTER (sales IS NULL)", "CASE WHEN value = 0 THEN 'good' ELSE 'bad' END"),
    "negative_profit": ("COUNT(*) FILTER (profit < 0)", "'neutral'"),
    "zero_sales": ("COUNT(*) FILTER (sales = 0)", "'neutral'"),
    "duplicate_items": (
        "COUNT(*) - COUNT(DISTINCT order_item_id) - CAST(COALESCE(BOOL_OR(order_item_id IS NULL), FALSE) AS INTEGER)",
        "CASE WHEN value = 0 THEN 'good' ELSE 'bad' END",
    ),
}


def _check(name: str) -> str:
    value, status = CHECKS[name]
    return (
        f"SELECT '{name}' AS \"check\", value, {status} AS status "
        f"FROM (SELECT CAST({value} AS BIGINT) AS value {PAGE})"
    )


for _name in CHECKS:
    ORACLES[f"dq_{_name}"] = with_star(_check(_name))
ORACLES["dq_health_report"] = with_star("\nUNION ALL\n".join(_check(n) for n in CHECKS))
SCORES = (
    ("On-Time Delivery Rate", _rate("on_time_flag"), 70, "<"),
    ("Fulfillment Rate", _rate("is_fulfilled"), 90, "<"),
    ("Cancellation Rate", _rate("is_cancelled"), 5, ">"),
    ("Perfect Order Rate", _rate("perfect_order_flag"), 70, "<"),
    ("Avg Profit Margin", mean("profit_margin_pct"), 15, "<"),
)
ORACLES["dq_scorecard"] = with_star(
    "\nUNION ALL\n".join(
        f"SELECT '{n}' AS kpi, value, {t}e0 AS target, CASE WHEN value {op} {t} THEN 'AT RISK' ELSE 'GOOD' END AS status "
        f"FROM (SELECT COALESCE({x}, 0e0) AS value {PAGE})"
        for n, x, t, op in SCORES
    )
)
PRIMARY = (
    ("dim_customers", "customer_id"),
    ("dim_products", "product_id"),
    ("dim_suppliers", "supplier_id"),
    ("dim_date", "date_id"),
    ("dim_geography", "geo_id"),
    ("dim_suppliers", "department_id"),
)
ORACLES["dq_pk_unique"] = with_star(
    "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{k}' AS key_column, COUNT(*) AS repeated_keys "
        f"FROM (SELECT {k} FROM {t} GROUP BY {k} HAVING COUNT(*) > 1)"
        for t, k in PRIMARY
    )
)
ORACLES["dq_fk_orphans"] = with_star(
    "\nUNION ALL\n".join(
        f"SELECT '{k}' AS key_column, '{t}' AS table_name, COUNT(*) AS orphan_rows "
        f"FROM fact f WHERE f.{k} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {t} d WHERE d.{k} = f.{k})"
        for t, k in PRIMARY[:5]
    )
)

# ── profiling of the raw lines ──

# raw header -> (column of the raw CTE, Spark type of the raw frame), in frame order
RAW_COLUMNS = {
    "Type": ("payment_type", "string"),
    "Days for shipping (real)": ("days_shipping_real", "int"),
    "Days for shipment (scheduled)": ("days_shipping_scheduled", "int"),
    "Order Profit Per Order": ("profit", "decimal(16,4)"),
    "Delivery Status": ("delivery_status", "string"),
    "Late_delivery_risk": ("late_delivery_risk", "int"),
    "Product Category Id": ("category_id", "bigint"),
    "Category Name": ("category", "string"),
    "Customer City": ("customer_city", "string"),
    "Customer Country": ("customer_country", "string"),
    "Customer Email": ("email", "string"),
    "Customer Fname": ("first_name", "string"),
    "Customer Id": ("customer_id", "bigint"),
    "Customer Lname": ("last_name", "string"),
    "Customer Segment": ("segment", "string"),
    "Customer State": ("customer_state", "string"),
    "Customer Zipcode": ("zipcode", "string"),
    "Department Id": ("department_id", "bigint"),
    "Department Name": ("department_name", "string"),
    "Market": ("market", "string"),
    "Order City": ("order_city", "string"),
    "Order Country": ("order_country", "string"),
    "Order Customer Id": ("order_customer_id", "bigint"),
    "Order Id": ("order_id", "bigint"),
    "Order Item Cardprod Id": ("cardprod_id", "bigint"),
    "Order Item Discount": ("discount", "decimal(16,4)"),
    "Order Item Discount Rate": ("discount_rate", "decimal(4,2)"),
    "Order Item Id": ("order_item_id", "bigint"),
    "Order Item Product Price": ("unit_price", "decimal(12,2)"),
    "Order Item Profit Ratio": ("profit_ratio", "decimal(4,2)"),
    "Order Item Quantity": ("quantity", "int"),
    "Sales": ("sales", "decimal(12,2)"),
    "Order Item Total": ("item_total", "decimal(16,4)"),
    "Order Region": ("order_region", "string"),
    "Order State": ("order_state", "string"),
    "Order Status": ("order_status", "string"),
    "Product Card Id": ("product_id", "bigint"),
    "Product Name": ("product_name", "string"),
    "Product Price": ("product_price", "decimal(12,2)"),
    "Product Status": ("product_status", "int"),
    "Shipping Mode": ("shipping_mode", "string"),
    "order date (DateOrders)": ("order_date", "string"),
    "shipping date (DateOrders)": ("ship_date", "string"),
}
_NULL_PCT = r("CAST(COUNT(*) - COUNT({0}) AS DOUBLE) / COUNT(*) * 100e0", 2)
ORACLES["profile_columns"] = with_raw(
    "\nUNION ALL\n".join(
        f"SELECT '{h}' AS \"column\", '{t}' AS dtype, COUNT(*) - COUNT({c}) AS nulls, {_NULL_PCT.format(c)} AS null_pct, "
        f"COUNT(DISTINCT {c}) AS unique_values, COALESCE(MIN(CAST({c} AS VARCHAR)), 'N/A') AS sample FROM raw"
        for h, (c, t) in RAW_COLUMNS.items()
    )
)
DOMAINS = {
    "ORDER / TRANSACTION": (
        "Order Id;order date (DateOrders);Order Status;shipping date (DateOrders);Shipping Mode;"
        "Days for shipping (real);Days for shipment (scheduled);Delivery Status;Late_delivery_risk;Sales;"
        "Order Item Quantity;Order Item Discount;Order Item Discount Rate;Order Item Product Price;"
        "Order Item Profit Ratio;Order Profit Per Order;Order Item Total"
    ),
    "CUSTOMER": (
        "Customer Id;Customer Fname;Customer Lname;Customer Email;Customer Segment;Customer City;Customer State;"
        "Customer Country;Customer Zipcode"
    ),
    "PRODUCT": "Product Card Id;Product Name;Product Category Id;Category Name;Product Price;Product Status",
    "GEOGRAPHY": "Market;Order Region;Order Country;Order City;Order State;Latitude;Longitude",
}
ORACLES["profile_domains"] = with_raw(
    "\nUNION ALL\n".join(
        f"SELECT '{d}' AS domain, '{h}' AS \"column\", {int(h in RAW_COLUMNS)} AS present, "
        + (f"COUNT({RAW_COLUMNS[h][0]})" if h in RAW_COLUMNS else "CAST(SUM(0) AS BIGINT)")
        + " AS filled_rows FROM raw"
        for d, headers in DOMAINS.items()
        for h in headers.split(";")
    )
)
ORACLES["profile_business_stats"] = with_cleaned(f"""
SELECT COUNT(DISTINCT order_id) AS total_orders, COUNT(DISTINCT customer_id) AS total_customers,
       COUNT(DISTINCT product_id) AS total_products, COUNT(DISTINCT category) AS total_categories,
       COUNT(DISTINCT market) AS markets, COUNT(DISTINCT order_region) AS order_regions,
       {text('MIN(order_date)')} AS first_order, {text('MAX(order_date)')} AS last_order,
       {money('sales')} AS total_revenue, {money('profit')} AS total_profit, {avg('profit')} AS avg_profit,
       {pct('late_delivery_risk', 1)} AS late_risk_pct
FROM cleaned""")
ORACLES["profile_distinct_values"] = with_cleaned(
    "\nUNION ALL\n".join(
        f"SELECT DISTINCT '{c}' AS \"column\", {c} AS value FROM cleaned"
        for c in ("delivery_status", "order_status", "shipping_mode", "market", "segment")
    )
)
ORACLES["profile_nulls"] = with_raw(
    "SELECT * FROM (\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{h}' AS \"column\", COUNT(*) - COUNT({c}) AS nulls, {_NULL_PCT.format(c)} AS null_pct, "
        "CAST(0 AS BIGINT) AS nulls_after_fill FROM raw"
        for h, (c, _) in RAW_COLUMNS.items()
    )
    + "\n) WHERE nulls > 0"
)
ORACLES["profile_dates"] = with_cleaned(
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", strftime(MIN({c}), '%Y-%m-%d') AS min_date, "
        f"strftime(MAX({c}), '%Y-%m-%d') AS max_date, COUNT(*) - COUNT({c}) AS unparsed FROM cleaned"
        for c in ("order_date", "ship_date")
    )
)
ORACLES["domain_frames"] = with_raw(f"""
SELECT order_id, order_date, ship_date, order_status, shipping_mode, delivery_status, late_delivery_risk,
       days_shipping_real, days_shipping_scheduled, {_doubles('sales')}, quantity,
       {_doubles('discount discount_rate unit_price profit_ratio profit item_total')},
       customer_id, product_id, market, order_region, order_country, order_city, order_state
FROM raw""")
ORACLES["domain_frames_customers"] = with_raw("""
SELECT customer_id, first_name, last_name, email, segment, customer_city AS city, customer_state AS state,
       customer_country AS country, zipcode
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_item_id, first_name, last_name, email,
        segment, customer_city, customer_state, customer_country, zipcode) AS rn FROM raw)
WHERE rn = 1""")
ORACLES["domain_frames_products"] = with_raw("""
SELECT product_id, product_name, category, CAST(product_price AS DOUBLE) AS price, product_status AS status, category_id
FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY order_item_id, product_name, category,
        product_price, product_status, category_id) AS rn FROM raw)
WHERE rn = 1""")

# ── cleaning ──

ORACLES["fill_numeric_median"] = with_cleaned(f"""
SELECT {LINE}, CAST(quantity AS DOUBLE) AS quantity, {_doubles('sales discount_rate profit')},
       CAST(days_shipping_real AS DOUBLE) AS days_shipping_real
FROM cleaned_base""")
ORACLES["fill_text_unknown"] = with_raw(f"""
SELECT {LINE}, COALESCE(order_city, 'Unknown') AS order_city, order_status, customer_city FROM raw""")
ORACLES["parse_dates_lenient"] = with_cleaned(f"""
SELECT {LINE}, {text('order_date')} AS order_date, {text('ship_date')} AS ship_date FROM cleaned_base""")
ORACLES["date_parts"] = with_cleaned(f"""
SELECT {LINE}, order_year, order_month, order_quarter, order_dow FROM cleaned_base""")
ORACLES["rename_columns"] = with_raw(
    "SELECT "
    + ", ".join(
        f"CAST({c} AS DOUBLE) AS {c}" if t.startswith("decimal") else (f'{c} AS "{h}"' if c in ("order_date", "ship_date") else c)
        for h, (c, t) in RAW_COLUMNS.items()
    )
    + " FROM raw"
)
ORACLES["standardize_text"] = with_raw(
    f"SELECT {LINE}, " + ", ".join(f"{title(c)} AS {c}" for c in TITLED) + " FROM raw"
)
CLEAN_ORDER_ROW = ORDER_ROW.replace(" quantity,", " CAST(quantity AS DOUBLE) AS quantity,")
ORACLES["split_orders"] = with_cleaned(f"SELECT {CLEAN_ORDER_ROW} FROM cleaned")
ORACLES["split_customers"] = with_cleaned(f"""
SELECT {CUSTOMER_ROW}
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_item_id, first_name, last_name, email,
        segment, customer_city, customer_state, customer_country, zipcode) AS rn FROM cleaned)
WHERE rn = 1""")
ORACLES["split_products"] = with_cleaned(f"""
SELECT {PRODUCT_ROW}
FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY order_item_id, product_name, category, category_id,
        product_price, product_status, department_id, department_name) AS rn FROM cleaned)
WHERE rn = 1""")

# ── sources and sinks: what comes back is what went in ──

ORACLES["scan_raw_csv"] = ORACLES["rename_columns"]
ORACLES["scan_clean_csv"] = with_cleaned(f"SELECT {CLEAN_ORDER_ROW} FROM cleaned")
ORACLES["parse_csv_timestamps"] = ORACLES["parse_dates_lenient"]
ORACLES["scan_clean_csv_customers"] = ORACLES["split_customers"]
ORACLES["scan_clean_csv_products"] = ORACLES["split_products"]
ORACLES["scan_processed"] = ORACLES["enrich_orders"]
ORACLES["scan_processed_customers"] = ORACLES["dim_customers"]
ORACLES["scan_processed_products"] = ORACLES["dim_products"]
for _name, _rollup in (("monthly", "monthly"), ("regional", "regional"), ("shipping", "shipping")):
    ORACLES[f"scan_processed_kpi_{_name}"] = ORACLES[f"rollup_{_rollup}"]
ORACLES["scan_processed_supplier_metrics"] = ORACLES["rollup_supplier"]
ORACLES["sql_table_scan"] = with_star("""
SELECT market, order_status, COUNT(*) AS n_lines, CAST(SUM(quantity) AS BIGINT) AS units FROM report
GROUP BY market, order_status""")
_SAVED = {
    "orders_clean": ("cleaned", 39, "COUNT(*) FILTER (order_date IS NULL) * 5"),
    "customers_clean": ("(SELECT DISTINCT customer_id FROM cleaned)", 9, "0"),
    "products_clean": ("(SELECT DISTINCT product_id FROM cleaned)", 8, "0"),
}
ORACLES["save_cleaned"] = with_cleaned(
    "\nUNION ALL\n".join(
        f"SELECT '{n}' AS table_name, COUNT(*) AS n_rows, {k} AS n_columns, CAST({nulls} AS BIGINT) AS n_nulls FROM {src}"
        for n, (src, k, nulls) in _SAVED.items()
    )
)
_PROCESSED = {
    "orders": ("lines", 42),
    "customers": ("dim_customers", 9),
    "products": ("dim_products", 8),
    "kpi_monthly": ("(SELECT DISTINCT order_year, order_month FROM lines)", 17),
    "kpi_regional": ("(SELECT DISTINCT market, order_region FROM lines)", 9),
    "kpi_shipping": ("(SELECT DISTINCT shipping_mode FROM lines)", 7),
    "supplier_metrics": ("(SELECT DISTINCT department_id, department_name FROM lines)", 17),
}
ORACLES["readback_validation"] = with_star(
    "\nUNION ALL\n".join(
        f"SELECT '{n}' AS table_name, COUNT(*) AS n_rows, {k} AS n_columns, CAST(0 AS BIGINT) AS n_nulls FROM {src}"
        for n, (src, k) in _PROCESSED.items()
    )
)
ORACLES["save_processed"] = with_star(
    "\nUNION ALL\n".join(f"SELECT '{n}' AS table_name, COUNT(*) AS n_rows FROM {src}" for n, (src, _) in _PROCESSED.items())
)
ORACLES["save_kpi"] = ORACLES["kpi05_inventory_by_category"]
_WAREHOUSE = {
    "dim_customers": ("dim_customers", 9),
    "dim_products": ("dim_products", 8),
    "dim_suppliers": ("dim_suppliers", 3),
    "dim_date": ("dim_date", 9),
    "dim_geography": ("dim_geography", 6),
    "fact_orders": ("fact", 33),
    **{n: _PROCESSED[n] for n in ("kpi_monthly", "kpi_regional", "kpi_shipping", "supplier_metrics")},
}


def _exported(names) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{n}' AS table_name, 'ok' AS status, COUNT(*) AS n_rows, {_WAREHOUSE[n][1]} AS n_columns, "
        f"CAST(0 AS BIGINT) AS n_nulls FROM {_WAREHOUSE[n][0]}"
        for n in names
    )


ORACLES["bi_export_all"] = with_star(_exported(_WAREHOUSE))
ORACLES["warehouse_load"] = with_star(
    "\nUNION ALL\n".join(f"SELECT '{n}' AS table_name, COUNT(*) AS n_rows FROM {src}" for n, (src, _) in _WAREHOUSE.items())
)
ORACLES["run_log_append"] = with_lines("""
SELECT CAST(run_id AS BIGINT) AS run_id, status, n AS rows_processed, CASE WHEN status = 'SUCCESS' THEN n ELSE 0 END AS rows_inserted,
       'fact_orders' AS source_table, duration AS duration_secs, error_message
FROM (SELECT COUNT(*) AS n FROM lines),
     (VALUES (1, 'SUCCESS', 1.23e0, NULL), (2, 'FAILED', 0.5e0, 'no input'), (3, 'SUCCESS', 2e0, NULL))
       v(run_id, status, duration, error_message)""")

# ── batches ──

SHIFTED = f"""
shifted_base AS (
  SELECT * REPLACE (order_date + INTERVAL 1 DAY AS order_date, ship_date + INTERVAL 1 DAY AS ship_date) FROM base
),{derived('shifted_base', 'shifted')}"""


def with_shifted(body: str) -> str:
    return f"WITH {MAPPED},{derived('base', 'lines')},{SHIFTED}\n{body}"


ORACLES["shift_dates"] = with_shifted(f"""
SELECT {LINE}, {text('order_date')} AS order_date, {text('ship_date')} AS ship_date FROM shifted""")
ORACLES["assign_next_keys"] = with_lines("""
SELECT (SELECT MAX(order_item_id) FROM lines)
         + row_number() OVER (ORDER BY substr(md5(concat_ws('|', order_item_id, order_id, customer_id, product_id, sales)), 1, 3),
                              order_item_id, order_id, customer_id, product_id, sales)
         AS order_item_id,
       order_id, customer_id, product_id, CAST(sales AS DOUBLE) AS sales
FROM lines""")
BOTH = "(SELECT * FROM lines UNION ALL BY NAME SELECT * FROM shifted)"
ORACLES["fact_append"] = with_shifted(f"""
SELECT CAST(year(order_date) AS INTEGER) AS order_year, COUNT(*) AS n_lines, {money('sales')} AS revenue
FROM {BOTH} GROUP BY 1""")
_KEYS = {
    "fact_orders": "CAST(CAST(year(order_date) AS INTEGER) AS VARCHAR)",
    "kpi_monthly": "concat_ws('/', year(order_date), month(order_date))",
    "kpi_regional": "concat_ws('/', market, order_region)",
    "kpi_shipping": "shipping_mode",
    "supplier_metrics": "concat_ws('/', department_id, department_name)",
}
ORACLES["daily_append_refresh"] = with_shifted(
    "\nUNION ALL\n".join(
        f"SELECT '{n}' AS table_name, {k} AS key, COUNT(*) AS n_lines, {money('sales')} AS revenue FROM {BOTH} GROUP BY 2"
        for n, k in _KEYS.items()
    )
)
ORACLES["stream_append_refresh"] = ORACLES["daily_append_refresh"]
_REFRESHED = {
    "fact_orders": ("shifted", 33),
    "kpi_monthly": (f"(SELECT DISTINCT year(order_date), month(order_date) FROM {BOTH})", 13),
    "kpi_regional": (f"(SELECT DISTINCT market, order_region FROM {BOTH})", 8),
}
ORACLES["bi_export_refresh"] = with_shifted(
    "\nUNION ALL\n".join(
        f"SELECT '{n}' AS table_name, COUNT(*) AS n_rows, {k} AS n_columns, CAST(0 AS BIGINT) AS n_nulls FROM {src}"
        for n, (src, k) in _REFRESHED.items()
    )
)
ORACLES["run_history"] = with_lines("""
SELECT CAST(2 AS BIGINT) AS run_id, 'FAILED' AS status, CAST(0 AS BIGINT) AS rows_processed, CAST(0 AS BIGINT) AS rows_inserted,
       'fact_orders' AS source_table, 1 AS failed
UNION ALL SELECT CAST(1 AS BIGINT), 'SUCCESS', COUNT(*), COUNT(*), 'fact_orders', 0 FROM lines""")
