"""Profiling of raw or clean order lines."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, DoubleType, FloatType, NumericType, StringType

from orderloom.functions.measures import distinct_count
from orderloom.functions.rounding import round_exact, round_half_away
from orderloom.operators.keys import keep_first


def _percent(part: Column, whole: Column) -> Column:
    return round_half_away(F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0), 2)


def _name(c: str) -> Column:
    return F.col(f"`{c}`")


def profile_columns(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Per column: type, nulls, null %, number of different values, smallest value (as text) as sample.

    Every column is folded to its different values by itself, so no row is repeated for the others and a scan of a columnar
    table reads each column once; equal values combine on the map side, so a dominant one does not matter. With
    ``approximate`` the different values are sketched, all columns in one pass.
    """
    if approximate:
        columns = [
            F.struct(
                *_described(df, c),
                F.count_if(_name(c).isNull()).alias("nulls"),
                F.approx_count_distinct(_comparable(df, c)).alias("unique_values"),
                F.min(_as_text(df, c)).alias("sample"),
                F.count(F.lit(1)).alias("rows"),
            )
            for c in df.columns
        ]
        return _presented(df.select(F.array(*columns).alias("all")).select(F.inline("all")))
    counts = df.agg(*[F.count(_name(c)).alias(f"_{i}") for i, c in enumerate(df.columns)], F.count(F.lit(1)).alias("rows"))
    filled = counts.select(
        "rows", F.inline(F.array(*[F.struct(*_described(df, c), F.col(f"_{i}").alias("filled")) for i, c in enumerate(df.columns)]))
    )
    kinds = [
        df.select(_comparable(df, c).alias("value"))
        .where("value IS NOT NULL")
        .distinct()
        .agg(F.count(F.lit(1)).alias("unique_values"), F.min(F.col("value").cast("string")).alias("sample"))
        .select(F.lit(c).alias("column"), "unique_values", "sample")
        for c in df.columns
    ]
    found = filled.join(reduce(DataFrame.union, kinds), "column")
    return _presented(found.withColumn("nulls", F.col("rows") - F.col("filled")))


def profile_values(df: DataFrame) -> DataFrame:
    """``column, dtype, value, n``: the different values of every column as text, with their rows. Those of several batches
    are merged by :func:`profile_of`."""
    values = [
        df.groupBy(_comparable(df, c).alias("value")).agg(F.count(F.lit(1)).alias("n")).select(*_described(df, c), F.col("value").cast("string").alias("value"), "n")
        for c in df.columns
    ]
    return reduce(DataFrame.union, values)


def profile_of(values: DataFrame) -> DataFrame:
    """The profile of everything whose values were stored; exact, and without a look at the rows."""
    merged = values.groupBy("column", "dtype", "value").agg(F.sum("n").alias("n"))
    per_column = merged.groupBy("column", "dtype").agg(
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
        F.count("value").alias("unique_values"),
        F.min("value").alias("sample"),
        F.sum("n").alias("rows"),
    )
    return _presented(per_column)


def _described(df: DataFrame, c: str) -> list[Column]:
    return [F.lit(c).alias("column"), F.lit(df.schema[c].dataType.simpleString()).alias("dtype")]


def _presented(found: DataFrame) -> DataFrame:
    return found.select(
        "column",
        "dtype",
        "nulls",
        _percent(F.col("nulls"), F.col("rows")).alias("null_pct"),
        "unique_values",
        F.coalesce("sample", F.lit("N/A")).alias("sample"),
    )


def _comparable(df: DataFrame, c: str) -> Column:
    """The column in a type whose values can be grouped; equal values have one text."""
    dtype = df.schema[c].dataType
    if isinstance(dtype, (DoubleType, FloatType)):
        return _name(c) + F.lit(0.0)  # -0.0 and 0.0 are one value
    return _name(c) if isinstance(dtype, AtomicType) else _name(c).cast("string")


def _as_text(df: DataFrame, c: str) -> Column:
    return _comparable(df, c).cast("string")


# The raw columns each subject area expects.
DOMAINS = {
    "ORDER / TRANSACTION": (
        "Order Id",
        "order date (DateOrders)",
        "Order Status",
        "shipping date (DateOrders)",
        "Shipping Mode",
        "Days for shipping (real)",
        "Days for shipment (scheduled)",
        "Delivery Status",
        "Late_delivery_risk",
        "Sales",
        "Order Item Quantity",
        "Order Item Discount",
        "Order Item Discount Rate",
        "Order Item Product Price",
        "Order Item Profit Ratio",
        "Order Profit Per Order",
        "Order Item Total",
    ),
    "CUSTOMER": (
        "Customer Id",
        "Customer Fname",
        "Customer Lname",
        "Customer Email",
        "Customer Segment",
        "Customer City",
        "Customer State",
        "Customer Country",
        "Customer Zipcode",
    ),
    "PRODUCT": (
        "Product Card Id",
        "Product Name",
        "Product Category Id",
        "Category Name",
        "Product Price",
        "Product Status",
    ),
    "GEOGRAPHY": (
        "Market",
        "Order Region",
        "Order Country",
        "Order City",
        "Order State",
        "Latitude",
        "Longitude",
    ),
}


def profile_domains(df: DataFrame) -> DataFrame:
    """Per subject area and expected column: is it there, and in how many rows is it filled (0 if missing)."""
    expected = [(domain, c) for domain, columns in DOMAINS.items() for c in columns]
    present = [c for _, c in expected if c in df.columns]
    counts = df.agg(*[F.count(_name(c)).alias(c) for c in present])
    rows = [
        F.struct(
            F.lit(domain).alias("domain"),
            F.lit(c).alias("column"),
            F.lit(int(c in present)).alias("present"),
            (_name(c) if c in present else F.lit(0).cast("bigint")).alias("filled_rows"),
        )
        for domain, c in expected
    ]
    return counts.select(F.inline(F.array(*rows)))


def business_stats(lines: DataFrame) -> DataFrame:
    """Headline figures of clean lines, one row; dates compare as dates, not as text."""
    return lines.agg(
        distinct_count(lines, "order_id").alias("total_orders"),
        distinct_count(lines, "customer_id").alias("total_customers"),
        distinct_count(lines, "product_id").alias("total_products"),
        distinct_count(lines, "category").alias("total_categories"),
        distinct_count(lines, "market").alias("markets"),
        distinct_count(lines, "order_region").alias("order_regions"),
        F.min("order_date").alias("first_order"),
        F.max("order_date").alias("last_order"),
        round_exact(F.sum("sales"), 2).alias("total_revenue"),
        round_exact(F.sum("profit"), 2).alias("total_profit"),
        round_half_away(F.try_divide(F.sum("profit").cast("double"), F.count("profit").cast("double")), 2).alias(
            "avg_profit"
        ),
        round_half_away(
            F.try_divide(F.sum("late_delivery_risk").cast("double"), F.count("late_delivery_risk").cast("double"))
            * F.lit(100.0),
            1,
        ).alias("late_risk_pct"),
    )


CATEGORICAL = ("delivery_status", "order_status", "shipping_mode", "market", "segment")


def distinct_values(lines: DataFrame, columns: Sequence[str] = CATEGORICAL) -> DataFrame:
    """Rows ``(column, value)``: the different values of the categorical columns."""
    present = [c for c in columns if c in lines.columns]
    text = lines.select(*[F.col(c).cast("string").alias(c) for c in present])
    return text.unpivot([], present, "column", "value").distinct()


def null_counts(df: DataFrame) -> DataFrame:
    """Rows ``(column, nulls, rows)``, one per column."""
    counts = df.agg(
        *[F.count_if(_name(c).isNull()).alias(c) for c in df.columns],
        F.count(F.lit(1)).alias("_rows"),
    )
    return counts.unpivot(["_rows"], [_name(c) for c in df.columns], "column", "nulls").select(
        "column", "nulls", F.col("_rows").alias("rows")
    )


def profile_nulls(df: DataFrame) -> DataFrame:
    """Columns that have nulls: how many, what share, and how many are left after filling.

    What is left follows from the count: filling leaves no null in text, and none in a number column but one that holds
    nothing else; columns of other types are not filled.
    """
    left = {f.name: "number" if isinstance(f.dataType, NumericType) else "text" if isinstance(f.dataType, StringType) else "other" for f in df.schema.fields}
    kind = F.element_at(F.create_map(*[F.lit(x) for pair in left.items() for x in pair]), F.col("column"))
    after = (
        F.when(kind == "other", F.col("nulls"))
        .when((kind == "number") & (F.col("nulls") == F.col("rows")), F.col("rows"))
        .otherwise(F.lit(0))
    )
    return null_counts(df).where("nulls > 0").select(
        "column", "nulls", _percent(F.col("nulls"), F.col("rows")).alias("null_pct"), after.cast("bigint").alias("nulls_after_fill")
    )


def profile_dates(df: DataFrame, columns: Sequence[str] = ("order_date", "ship_date")) -> DataFrame:
    """Per date column: first day, last day, number of missing or unreadable dates."""
    aggs = []
    for c in columns:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"), F.count_if(F.col(c).isNull()).alias(f"bad_{c}")]
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.to_date(f"min_{c}").alias("min_date"),
            F.to_date(f"max_{c}").alias("max_date"),
            F.col(f"bad_{c}").alias("unparsed"),
        )
        for c in columns
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


# Raw header -> short name in the first split.
DOMAIN_ORDERS = {
    "Order Id": "order_id",
    "order date (DateOrders)": "order_date",
    "shipping date (DateOrders)": "ship_date",
    "Order Status": "order_status",
    "Shipping Mode": "shipping_mode",
    "Delivery Status": "delivery_status",
    "Late_delivery_risk": "late_delivery_risk",
    "Days for shipping (real)": "days_shipping_real",
    "Days for shipment (scheduled)": "days_shipping_scheduled",
    "Sales": "sales",
    "Order Item Quantity": "quantity",
    "Order Item Discount": "discount",
    "Order Item Discount Rate": "discount_rate",
    "Order Item Product Price": "unit_price",
    "Order Item Profit Ratio": "profit_ratio",
    "Order Profit Per Order": "profit",
    "Order Item Total": "item_total",
    "Customer Id": "customer_id",
    "Product Card Id": "product_id",
    "Market": "market",
    "Order Region": "order_region",
    "Order Country": "order_country",
    "Order City": "order_city",
    "Order State": "order_state",
}
DOMAIN_CUSTOMERS = {
    "Customer Id": "customer_id",
    "Customer Fname": "first_name",
    "Customer Lname": "last_name",
    "Customer Email": "email",
    "Customer Segment": "segment",
    "Customer City": "city",
    "Customer State": "state",
    "Customer Country": "country",
    "Customer Zipcode": "zipcode",
}
DOMAIN_PRODUCTS = {
    "Product Card Id": "product_id",
    "Product Name": "product_name",
    "Category Name": "category",
    "Product Price": "price",
    "Product Status": "status",
    "Product Category Id": "category_id",
}


def domain_frames(raw: DataFrame) -> dict[str, DataFrame]:
    """First split of raw lines, uncleaned, under short names; one row per customer and product."""

    def picked(names: dict[str, str], *extra: Column) -> DataFrame:
        return raw.select(*[_name(k).alias(v) for k, v in names.items() if k in raw.columns], *extra)

    item = [_name("Order Item Id").alias("_item")] if "Order Item Id" in raw.columns else []
    customers, products = picked(DOMAIN_CUSTOMERS, *item), picked(DOMAIN_PRODUCTS, *item)
    return {
        "orders": picked(DOMAIN_ORDERS),
        "customers": keep_first(customers, "customer_id", ["_item"], [c for c in customers.columns if c != "_item"]),
        "products": keep_first(products, "product_id", ["_item"], [c for c in products.columns if c != "_item"]),
    }
