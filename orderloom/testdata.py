"""Order lines from the driver's test tables. The only module that knows their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.schemas import RAW_DATES, RAW_RENAMES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dec(c: str, precision: int, scale: int) -> Column:
    return F.col(c).cast(f"decimal({precision},{scale})")


#: What order lines take from the test tables, once each.
JOINED_COLUMNS = (
    *("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "returned", "l_extendedprice", "l_quantity", "l_discount", "l_tax"),
    *("o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "c_name", "c_mktsegment", "n_name", "r_name"),
    *("p_name", "p_brand", "p_type", "p_retailprice"),
)


def joined_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line with the columns of the test tables that order lines are made of; a third of the bytes of the
    lines themselves."""
    t = {n: table(spark, sf_dir, n) for n in ("lineitem", "orders", "customer", "nation", "region", "part")}
    # Orders meet their customers, and lines their parts, before they meet one another: no shuffle carries the columns of
    # all four. The order key comes last, so the lines of an order lie together, which later distinct counts fold and
    # column files compress. Nation and region have 25 and 5 rows at any scale, so they are broadcast, last of all: no
    # shuffle carries their names. The other sides are left to Spark's size threshold.
    heads = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
    returned = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    lines = t["lineitem"].withColumn("returned", returned).drop("l_returnflag", "l_linestatus")
    return (
        lines.join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
        .join(heads, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(F.broadcast(t["nation"]), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(F.broadcast(t["region"]), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(*JOINED_COLUMNS)
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line, all order, customer and product columns, nothing derived."""
    return as_order_lines(joined_tables(spark, sf_dir))


def as_order_lines(joined: DataFrame) -> DataFrame:
    """Order lines from the rows of :func:`joined_tables`, as planned or as stored."""
    real = F.pmod(F.datediff("l_shipdate", "o_orderdate"), F.lit(7))
    priority = F.col("o_orderpriority")
    scheduled = F.when(priority == "1-URGENT", 0).when(priority == "2-HIGH", 1).when(priority == "3-MEDIUM", 2).otherwise(4)
    mode = (
        F.when(priority == "1-URGENT", "Same Day")
        .when(priority == "2-HIGH", "First Class")
        .when(priority == "3-MEDIUM", "Second Class")
        .otherwise("Standard Class")
    )
    returned, state = F.col("returned"), F.col("o_orderstatus")
    status = (
        F.when(returned & (state == "F"), "Canceled")
        .when(returned & (state == "P"), "Suspected_Fraud")
        .when(state == "F", "Complete")
        .when(state == "O", "Processing")
        .otherwise("Pending")
    )
    base = joined.select(
        F.col("l_orderkey").alias("order_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_item_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_orderdate").cast("timestamp").alias("order_date"),
        F.col("l_shipdate").cast("timestamp").alias("ship_date"),
        status.alias("order_status"),
        mode.alias("shipping_mode"),
        real.alias("days_shipping_real"),
        scheduled.alias("days_shipping_scheduled"),
        _dec("l_extendedprice", 12, 2).alias("sales"),
        F.col("l_quantity").cast("int").alias("quantity"),
        _dec("p_retailprice", 12, 2).alias("unit_price"),
        _dec("l_discount", 4, 2).alias("discount_rate"),
        (F.lit(0.15).cast("decimal(4,2)") - _dec("l_discount", 4, 2) - _dec("l_tax", 4, 2))
        .cast("decimal(4,2)")
        .alias("profit_ratio"),
        F.col("r_name").alias("market"),
        F.col("n_name").alias("order_region"),
        F.col("n_name").alias("order_country"),
        F.concat("n_name", F.lit("-"), (F.col("o_custkey") % 10).cast("string")).alias("order_city"),
        F.concat("n_name", F.lit("-S"), (F.col("o_custkey") % 3).cast("string")).alias("order_state"),
        F.element_at(
            F.array(*[F.lit(v) for v in ("DEBIT", "TRANSFER", "CASH", "PAYMENT")]),
            (F.col("l_orderkey") % 4 + 1).cast("int"),
        ).alias("payment_type"),
        F.substr("p_brand", F.lit(7)).cast("int").cast("bigint").alias("department_id"),
        F.col("p_brand").alias("department_name"),
        F.col("p_type").alias("category"),
        F.col("p_name").alias("product_name"),
        _dec("p_retailprice", 12, 2).alias("product_price"),
        F.lit(0).alias("product_status"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_name").alias("first_name"),
        F.lit("Unknown").alias("last_name"),
        F.lit("masked").alias("email"),
        (F.col("o_custkey") % 100000).cast("string").alias("zipcode"),
        "l_linenumber",
    )
    delay = F.col("days_shipping_real") - F.col("days_shipping_scheduled")
    delivery = (
        F.when(F.col("order_status").isin("Canceled", "Suspected_Fraud"), "Shipping Canceled")
        .when(delay > 0, "Late Delivery")
        .when(delay == 0, "Shipping On Time")
        .otherwise("Advance Shipping")
    )
    discount = (F.col("sales") * F.col("discount_rate")).cast("decimal(16,4)")
    return base.withColumns(
        {
            "delivery_status": delivery,
            "late_delivery_risk": F.when(delay > 0, 1).otherwise(0),
            "discount": discount,
            "item_total": (F.col("sales") - discount).cast("decimal(16,4)"),
            "profit": (F.col("sales") * F.col("profit_ratio")).cast("decimal(16,4)"),
            "category_id": _category_id(),
            "customer_city": F.col("order_city"),
            "customer_state": F.col("order_state"),
            "customer_country": F.col("order_country"),
            "order_customer_id": F.col("customer_id"),
            "cardprod_id": F.col("product_id"),
            "order_year": F.year("order_date"),
            "order_month": F.month("order_date"),
            "order_quarter": F.quarter("order_date"),
            "order_dow": F.date_format("order_date", "EEEE"),
        }
    )


# The product types of the test tables, in their sort order; the id is the position from 1.
CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


def _category_id() -> Column:
    positions = F.array(*[F.lit(c) for c in CATEGORIES])
    return F.array_position(positions, F.upper("category")).cast("bigint")


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order lines as a raw file would hold them: raw headers, text dates, and defects.

    Defects: quantity 13 is missing, the city of every eleventh customer is missing, the
    order date of every 97th order is unreadable, status and category are untidy, the
    seventh line of an order has no sales.
    """
    lines = order_lines(spark, sf_dir)
    text_date = "M/d/yyyy H:mm"
    dirty = lines.withColumns(
        {
            "sales": F.when(F.col("l_linenumber") == 7, F.lit(0).cast("decimal(12,2)")).otherwise(F.col("sales")),
            "quantity": F.nullif(F.col("quantity"), F.lit(13)),
            "order_city": F.when(F.col("customer_id") % 11 != 0, F.col("order_city")),
            "order_status": F.concat(F.lit("  "), F.upper("order_status"), F.lit("\t")),
            "category": F.concat(F.lower("category"), F.lit("'S  GOODS")),
            "_order_text": F.when(F.col("order_id") % 97 == 0, "bad").otherwise(F.date_format("order_date", text_date)),
            "_ship_text": F.date_format("ship_date", text_date),
        }
    )
    names = {v: k for k, v in RAW_RENAMES.items()}
    return dirty.select(
        *[F.col(v).alias(k) for v, k in names.items() if v in dirty.columns],
        *[F.col(t).alias(raw) for t, raw in zip(("_order_text", "_ship_text"), RAW_DATES)],
    )
