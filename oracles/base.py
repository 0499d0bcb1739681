"""Common table expressions: mapped order lines, star schema, dirty raw lines."""

from __future__ import annotations


def r(x: str, places: int) -> str:
    """Round a DOUBLE half away from zero."""
    scale = f"1{'0' * places}e0"
    return f"(sign({x}) * floor(abs({x}) * {scale} + 0.5e0) / {scale} + 0e0)"


def mean(c: str, scale: str = "") -> str:
    return f"(CAST(SUM({c}) AS DOUBLE) / COUNT({c}){scale})"


def avg(c: str, places: int = 2) -> str:
    return r(mean(c), places)


def pct(c: str, places: int = 2) -> str:
    return r(mean(c, " * 100e0"), places)


def money(c: str, places: int = 2) -> str:
    return f"CAST(ROUND(SUM({c}), {places}) AS DOUBLE)"


def total(c: str) -> str:
    return f"CAST(SUM({c}) AS DOUBLE)"


def units(c: str) -> str:
    return f"CAST(SUM({c}) AS BIGINT)"


def quotient(top: str, bottom: str, scale: str = "") -> str:
    return f"(CAST(SUM({top}) AS DOUBLE) / NULLIF(CAST(SUM({bottom}) AS DOUBLE), 0e0){scale})"


def text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


MAPPED = """
mapped AS (
  SELECT l_orderkey AS order_id,
         l_orderkey * 10 + l_linenumber AS order_item_id,
         o_custkey AS customer_id,
         l_partkey AS product_id,
         o_orderdate AS order_date,
         l_shipdate AS ship_date,
         CAST(((date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) % 7) + 7) % 7 AS INTEGER)
           AS days_shipping_real,
         CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 ELSE 4 END
           AS days_shipping_scheduled,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Same Day' WHEN '2-HIGH' THEN 'First Class'
           WHEN '3-MEDIUM' THEN 'Second Class' ELSE 'Standard Class' END AS shipping_mode,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' AND o_orderstatus = 'F' THEN 'Canceled'
              WHEN l_returnflag = 'R' AND l_linestatus = 'O' AND o_orderstatus = 'P' THEN 'Suspected_Fraud'
              WHEN o_orderstatus = 'F' THEN 'Complete'
              WHEN o_orderstatus = 'O' THEN 'Processing'
              ELSE 'Pending' END AS order_status,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS sales,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price,
         CAST(l_discount AS DECIMAL(4,2)) AS discount_rate,
         CAST(CAST(0.15 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)) - CAST(l_tax AS DECIMAL(4,2))
           AS DECIMAL(4,2)) AS profit_ratio,
         r_name AS market, n_name AS order_region, n_name AS order_country,
         n_name || '-' || CAST(c_custkey % 10 AS VARCHAR) AS order_city,
         n_name || '-S' || CAST(c_custkey % 3 AS VARCHAR) AS order_state,
         CASE o_orderkey % 4 WHEN 0 THEN 'DEBIT' WHEN 1 THEN 'TRANSFER' WHEN 2 THEN 'CASH' ELSE 'PAYMENT' END
           AS payment_type,
         CAST(substr(p_brand, 7) AS BIGINT) AS department_id,
         p_brand AS department_name,
         p_type AS category,
         CAST((SELECT COUNT(DISTINCT q.p_type) FROM part q WHERE q.p_type <= p.p_type) AS BIGINT) AS category_id,
         p_name AS product_name,
         CAST(p_retailprice AS DECIMAL(12,2)) AS product_price,
         0 AS product_status,
         c_mktsegment AS segment, c_name AS first_name, 'Unknown' AS last_name, 'masked' AS email,
         CAST(c_custkey % 100000 AS VARCHAR) AS zipcode,
         l_linenumber
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part p ON l_partkey = p_partkey
),
base AS (
  SELECT *,
         CASE WHEN order_status IN ('Canceled', 'Suspected_Fraud') THEN 'Shipping Canceled'
              WHEN days_shipping_real > days_shipping_scheduled THEN 'Late Delivery'
              WHEN days_shipping_real = days_shipping_scheduled THEN 'Shipping On Time'
              ELSE 'Advance Shipping' END AS delivery_status,
         CASE WHEN days_shipping_real > days_shipping_scheduled THEN 1 ELSE 0 END AS late_delivery_risk,
         CAST(sales * discount_rate AS DECIMAL(16,4)) AS discount,
         CAST(sales - CAST(sales * discount_rate AS DECIMAL(16,4)) AS DECIMAL(16,4)) AS item_total,
         CAST(sales * profit_ratio AS DECIMAL(16,4)) AS profit,
         order_city AS customer_city, order_state AS customer_state, order_country AS customer_country,
         customer_id AS order_customer_id, product_id AS cardprod_id,
         CAST(year(order_date) AS INTEGER) AS order_year,
         CAST(month(order_date) AS INTEGER) AS order_month,
         CAST(quarter(order_date) AS INTEGER) AS order_quarter,
         dayname(order_date) AS order_dow
  FROM mapped
)"""


def derived(source: str, target: str) -> str:
    """The business columns on top of ``source``."""
    margin = r("CAST(profit AS DOUBLE) / CAST(sales AS DOUBLE) * 100e0", 2)
    return f"""
{target}_flags AS (
  SELECT *,
         days_shipping_real - days_shipping_scheduled AS delivery_delay_days,
         CASE WHEN days_shipping_real - days_shipping_scheduled <= 0 THEN 1 ELSE 0 END AS on_time_flag,
         CASE WHEN sales <> 0 THEN CAST({margin} AS DECIMAL(18,2)) ELSE 0 END AS profit_margin_pct,
         CASE WHEN lower(order_status) = 'canceled' THEN 1 ELSE 0 END AS is_cancelled,
         CASE WHEN lower(order_status) <> 'canceled' AND lower(delivery_status) <> 'shipping canceled'
              THEN 1 ELSE 0 END AS is_fulfilled,
         CAST(unit_price * quantity - profit AS DECIMAL(18,4)) AS cost_per_order,
         CAST(date_diff('day', CAST(order_date AS DATE), CAST(ship_date AS DATE)) AS INTEGER) AS processing_days,
         CAST(weekofyear(order_date) AS INTEGER) AS order_week
  FROM {source}
),
{target} AS (
  SELECT *,
         CASE WHEN is_fulfilled = 0 THEN sales ELSE CAST(0 AS DECIMAL(12,2)) END AS revenue_at_risk,
         CASE WHEN on_time_flag = 1 AND is_fulfilled = 1 THEN 1 ELSE 0 END AS perfect_order_flag
  FROM {target}_flags
)"""


STAR = """
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS date,
         CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
         CAST(quarter(d) AS INTEGER) AS quarter, CAST(weekofyear(d) AS INTEGER) AS week,
         dayname(d) AS day_of_week, CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend
  FROM (SELECT DISTINCT CAST(order_date AS DATE) AS d FROM lines WHERE order_date IS NOT NULL)
),
dim_geography AS (
  SELECT row_number() OVER (ORDER BY market, order_region, order_country, order_city, order_state) AS geo_id, *
  FROM (SELECT DISTINCT market, order_region, order_country, order_city, order_state FROM lines
        WHERE market IS NOT NULL AND order_region IS NOT NULL AND order_country IS NOT NULL
          AND order_city IS NOT NULL AND order_state IS NOT NULL)
),
dim_suppliers AS (
  SELECT row_number() OVER (ORDER BY department_id, department_name) AS supplier_id, *
  FROM (SELECT DISTINCT department_id, department_name FROM lines
        WHERE department_id IS NOT NULL AND department_name IS NOT NULL)
),
dim_customers AS (
  SELECT customer_id, first_name, last_name, email, segment, customer_city, customer_state, customer_country, zipcode
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_item_id, first_name, last_name, email,
          segment, customer_city, customer_state, customer_country, zipcode) AS rn FROM lines)
  WHERE rn = 1
),
dim_products AS (
  SELECT product_id, product_name, category, category_id, product_price, product_status, department_id, department_name
  FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY order_item_id, product_name, category,
          category_id, product_price, product_status, department_id, department_name) AS rn FROM lines)
  WHERE rn = 1
),
fact AS (
  SELECT l.order_id, l.order_item_id, l.customer_id, l.product_id, s.supplier_id,
         CAST(strftime(l.order_date, '%Y%m%d') AS INTEGER) AS date_id, g.geo_id,
         l.order_date, l.ship_date, l.order_status, l.shipping_mode, l.delivery_status, l.late_delivery_risk,
         l.payment_type, l.days_shipping_real, l.days_shipping_scheduled, l.delivery_delay_days, l.processing_days,
         l.on_time_flag, l.is_cancelled, l.is_fulfilled, l.perfect_order_flag,
         l.sales, l.quantity, l.discount, l.discount_rate, l.unit_price, l.profit_ratio, l.profit, l.item_total,
         l.profit_margin_pct, l.cost_per_order, l.revenue_at_risk
  FROM lines l
  LEFT JOIN dim_suppliers s ON l.department_id = s.department_id
  LEFT JOIN dim_geography g ON l.market = g.market AND l.order_region = g.order_region
    AND l.order_country = g.order_country AND l.order_city = g.order_city AND l.order_state = g.order_state
),
report AS (
  SELECT f.*, d.year, d.month, d.month_name, d.quarter, g.market, g.order_region, g.order_country, c.segment,
         p.category, p.product_name, s.department_name
  FROM fact f
  LEFT JOIN dim_date d ON f.date_id = d.date_id
  LEFT JOIN dim_geography g ON f.geo_id = g.geo_id
  LEFT JOIN dim_customers c ON f.customer_id = c.customer_id
  LEFT JOIN dim_products p ON f.product_id = p.product_id
  LEFT JOIN dim_suppliers s ON f.supplier_id = s.supplier_id
)"""

# The defects of a raw file on top of the mapped lines; dates are text, names already clean.
RAW = """
raw AS (
  SELECT * REPLACE (
           CASE WHEN l_linenumber = 7 THEN CAST(0 AS DECIMAL(12,2)) ELSE sales END AS sales,
           NULLIF(quantity, 13) AS quantity,
           CASE WHEN customer_id % 11 <> 0 THEN order_city END AS order_city,
           '  ' || upper(order_status) || chr(9) AS order_status,
           lower(category) || '''S  GOODS' AS category,
           CASE WHEN order_id % 97 = 0 THEN 'bad' ELSE strftime(order_date, '%-m/%-d/%Y %-H:%M') END AS order_date,
           strftime(ship_date, '%-m/%-d/%Y %-H:%M') AS ship_date)
  FROM base
)"""


def title(c: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower(trim({c}, ' ' || chr(9))), '[a-z]+|[^a-z]+'), "
        "lambda y: concat(upper(y[1]), y[2:])), '')"
    )


TITLED = ("order_status", "shipping_mode", "delivery_status", "market", "order_region", "segment", "category",
          "payment_type", "department_name")

# Nulls filled, dates parsed, text standardized.
CLEANED = f"""
medians AS (SELECT median(CAST(quantity AS DOUBLE)) AS quantity FROM raw),
parsed AS (
  SELECT * REPLACE (
           try_strptime(order_date, '%-m/%-d/%Y %-H:%M') AS order_date,
           try_strptime(ship_date, '%-m/%-d/%Y %-H:%M') AS ship_date)
  FROM raw
),
cleaned_base AS (
  SELECT * REPLACE (
           CAST(COALESCE(quantity, (SELECT quantity FROM medians)) AS DECIMAL(18,1)) AS quantity,
           COALESCE(order_city, 'Unknown') AS order_city,
           CAST(year(order_date) AS INTEGER) AS order_year,
           CAST(month(order_date) AS INTEGER) AS order_month,
           CAST(quarter(order_date) AS INTEGER) AS order_quarter,
           dayname(order_date) AS order_dow,
           {", ".join(f"{title(c)} AS {c}" for c in TITLED)})
  FROM parsed
)"""


def with_lines(body: str) -> str:
    return f"WITH {MAPPED},{derived('base', 'lines')}\n{body}"


def with_star(body: str) -> str:
    return f"WITH {MAPPED},{derived('base', 'lines')},{STAR}\n{body}"


def with_raw(body: str) -> str:
    return f"WITH {MAPPED},{RAW}\n{body}"


def with_cleaned(body: str) -> str:
    return f"WITH {MAPPED},{RAW},{CLEANED},{derived('cleaned_base', 'cleaned')}\n{body}"
