"""Column contracts and the fixed names of the order data."""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Money arrives as text with up to nine decimals; 16 digits before the point hold any amount, and price times
# quantity minus profit still fits 38 digits without loss. A number that doesn't fit is an error, never a null.
MONEY = DecimalType(25, 9)
# Any number as text, before it is known to be whole.
ANY_NUMBER = DecimalType(38, 9)
PERCENT = DecimalType(18, 2)

# Raw file header -> column name.
RAW_RENAMES = {
    "Type": "payment_type",
    "Days for shipping (real)": "days_shipping_real",
    "Days for shipment (scheduled)": "days_shipping_scheduled",
    "Delivery Status": "delivery_status",
    "Late_delivery_risk": "late_delivery_risk",
    "Category Name": "category",
    "Customer City": "customer_city",
    "Customer Country": "customer_country",
    "Customer Email": "email",
    "Customer Fname": "first_name",
    "Customer Id": "customer_id",
    "Customer Lname": "last_name",
    "Customer Segment": "segment",
    "Customer State": "customer_state",
    "Customer Zipcode": "zipcode",
    "Department Id": "department_id",
    "Department Name": "department_name",
    "Latitude": "latitude",
    "Longitude": "longitude",
    "Market": "market",
    "Order City": "order_city",
    "Order Country": "order_country",
    "Order Customer Id": "order_customer_id",
    "Order Id": "order_id",
    "Order Item Cardprod Id": "cardprod_id",
    "Order Item Discount": "discount",
    "Order Item Discount Rate": "discount_rate",
    "Order Item Id": "order_item_id",
    "Order Item Product Price": "unit_price",
    "Order Item Profit Ratio": "profit_ratio",
    "Order Item Quantity": "quantity",
    "Sales": "sales",
    "Order Item Total": "item_total",
    "Order Profit Per Order": "profit",
    "Order Region": "order_region",
    "Order State": "order_state",
    "Order Status": "order_status",
    "Product Card Id": "product_id",
    "Product Category Id": "category_id",
    "Product Name": "product_name",
    "Product Price": "product_price",
    "Product Status": "product_status",
    "Shipping Mode": "shipping_mode",
}
RAW_DATES = {
    "order date (DateOrders)": "order_date",
    "shipping date (DateOrders)": "ship_date",
}
RAW_DATE_FORMATS = ("M/d/yyyy H:mm",)
CLEAN_DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Types by column name. Names not listed are text.
COLUMN_TYPES: dict[str, DataType] = {
    **dict.fromkeys(
        (
            "order_id",
            "order_item_id",
            "customer_id",
            "product_id",
            "order_customer_id",
            "cardprod_id",
            "category_id",
            "department_id",
            "supplier_id",
            "geo_id",
        ),
        LongType(),
    ),
    **dict.fromkeys(
        (
            "late_delivery_risk",
            "days_shipping_real",
            "days_shipping_scheduled",
            "delivery_delay_days",
            "processing_days",
            "quantity",
            "product_status",
            "order_year",
            "order_month",
            "order_quarter",
            "order_week",
            "date_id",
            "on_time_flag",
            "is_cancelled",
            "is_fulfilled",
            "perfect_order_flag",
        ),
        IntegerType(),
    ),
    **dict.fromkeys(
        (
            "sales",
            "discount",
            "discount_rate",
            "unit_price",
            "profit_ratio",
            "profit",
            "item_total",
            "product_price",
            "revenue_at_risk",
            "cost_per_order",
        ),
        MONEY,
    ),
    "profit_margin_pct": PERCENT,
    "latitude": DoubleType(),
    "longitude": DoubleType(),
    "order_date": TimestampType(),
    "ship_date": TimestampType(),
}

TEXT_COLUMNS = (
    "order_status",
    "shipping_mode",
    "delivery_status",
    "market",
    "order_region",
    "segment",
    "category",
    "payment_type",
    "department_name",
)
GEO_COLUMNS = ("market", "order_region", "order_country", "order_city", "order_state")
FLAG_COLUMNS = ("on_time_flag", "is_cancelled", "is_fulfilled", "perfect_order_flag", "late_delivery_risk")
AMOUNT_COLUMNS = (
    "sales",
    "profit",
    "discount",
    "profit_margin_pct",
    "cost_per_order",
    "revenue_at_risk",
    "item_total",
)

# Columns in their order.
ORDER_COLUMNS = (
    "order_id",
    "order_item_id",
    "customer_id",
    "product_id",
    "order_date",
    "ship_date",
    "order_year",
    "order_month",
    "order_quarter",
    "order_dow",
    "order_status",
    "shipping_mode",
    "delivery_status",
    "late_delivery_risk",
    "days_shipping_real",
    "days_shipping_scheduled",
    "delivery_delay_days",
    "on_time_flag",
    "sales",
    "quantity",
    "discount",
    "discount_rate",
    "unit_price",
    "profit_ratio",
    "profit",
    "item_total",
    "profit_margin_pct",
    "is_cancelled",
    "is_fulfilled",
    "revenue_at_risk",
    "cost_per_order",
    "market",
    "order_region",
    "order_country",
    "order_city",
    "order_state",
    "payment_type",
    "department_id",
    "department_name",
)
ENRICHED_COLUMNS = [*ORDER_COLUMNS, "perfect_order_flag", "processing_days", "order_week"]
# Columns in their order.
CUSTOMER_COLUMNS = (
    "customer_id",
    "first_name",
    "last_name",
    "email",
    "segment",
    "customer_city",
    "customer_state",
    "customer_country",
    "zipcode",
)
# Columns in their order.
PRODUCT_COLUMNS = (
    "product_id",
    "product_name",
    "category",
    "category_id",
    "product_price",
    "product_status",
    "department_id",
    "department_name",
)
# Columns in their order.
FACT_COLUMNS = (
    "order_id",
    "order_item_id",
    "customer_id",
    "product_id",
    "supplier_id",
    "date_id",
    "geo_id",
    "order_date",
    "ship_date",
    "order_status",
    "shipping_mode",
    "delivery_status",
    "late_delivery_risk",
    "payment_type",
    "days_shipping_real",
    "days_shipping_scheduled",
    "delivery_delay_days",
    "processing_days",
    "on_time_flag",
    "is_cancelled",
    "is_fulfilled",
    "perfect_order_flag",
    "sales",
    "quantity",
    "discount",
    "discount_rate",
    "unit_price",
    "profit_ratio",
    "profit",
    "item_total",
    "profit_margin_pct",
    "cost_per_order",
    "revenue_at_risk",
)

# Storage column of batches of order rows; not part of any table's contract.
YEAR = "order_year"

# Warehouse: dimension -> key; fact foreign key -> dimension.
PRIMARY_KEYS = {
    "dim_customers": "customer_id",
    "dim_products": "product_id",
    "dim_suppliers": "supplier_id",
    "dim_date": "date_id",
    "dim_geography": "geo_id",
}
FOREIGN_KEYS = {
    "customer_id": "dim_customers",
    "product_id": "dim_products",
    "supplier_id": "dim_suppliers",
    "date_id": "dim_date",
    "geo_id": "dim_geography",
}
ROLLUP_TABLES = ("kpi_monthly", "kpi_regional", "kpi_shipping", "supplier_metrics")
WAREHOUSE_TABLES = (*PRIMARY_KEYS, "fact_orders", *ROLLUP_TABLES)
PROCESSED_TABLES = ("orders", "customers", "products", *ROLLUP_TABLES)
REFRESHED_TABLES = ("fact_orders", "kpi_monthly", "kpi_regional")

# Columns of the warehouse tables. The daily refresh publishes kpi_monthly and kpi_regional without
# the columns of REFRESH_DROPS.
TABLE_COLUMNS: dict[str, tuple[str, ...]] = {
    "dim_customers": CUSTOMER_COLUMNS,
    "dim_products": PRODUCT_COLUMNS,
    "dim_suppliers": (
        "supplier_id",
        "department_id",
        "department_name",
    ),
    "dim_date": (
        "date_id",
        "date",
        "year",
        "month",
        "month_name",
        "quarter",
        "week",
        "day_of_week",
        "is_weekend",
    ),
    "dim_geography": ("geo_id", *GEO_COLUMNS),
    "fact_orders": FACT_COLUMNS,
    "kpi_monthly": (
        "order_year",
        "order_month",
        "total_orders",
        "total_revenue",
        "total_profit",
        "avg_delay_days",
        "on_time_rate",
        "avg_profit_margin",
        "cancelled_orders",
        "fulfilled_orders",
        "perfect_orders",
        "revenue_at_risk",
        "avg_cost_per_order",
        "cancellation_rate_pct",
        "fulfillment_rate_pct",
        "perfect_order_rate_pct",
        "on_time_rate_pct",
    ),
    "kpi_regional": (
        "market",
        "order_region",
        "total_orders",
        "total_revenue",
        "total_profit",
        "on_time_rate",
        "avg_delay_days",
        "revenue_at_risk",
        "on_time_rate_pct",
    ),
    "kpi_shipping": (
        "shipping_mode",
        "total_orders",
        "avg_actual_days",
        "avg_delay_days",
        "on_time_rate",
        "total_revenue",
        "on_time_rate_pct",
    ),
    "supplier_metrics": (
        "department_id",
        "department_name",
        "total_orders",
        "total_revenue",
        "total_profit",
        "avg_delay_days",
        "on_time_rate",
        "avg_lead_time_days",
        "avg_profit_margin",
        "total_cancelled",
        "total_fulfilled",
        "total_revenue_at_risk",
        "distinct_products",
        "regions_served",
        "cancellation_rate",
        "fulfillment_rate",
        "on_time_rate_pct",
    ),
}
REFRESH_DROPS = {
    "kpi_monthly": ["on_time_rate", "cancellation_rate_pct", "fulfillment_rate_pct", "perfect_order_rate_pct"],
    "kpi_regional": ["on_time_rate"],
}

# Figures of the rollups that are counts; the others are numbers with decimals.
WHOLE_FIGURES = (
    "total_orders",
    "cancelled_orders",
    "fulfilled_orders",
    "perfect_orders",
    "total_cancelled",
    "total_fulfilled",
    "distinct_products",
    "regions_served",
)
DIM_DATE_TYPES: dict[str, DataType] = {
    "date": DateType(),
    **dict.fromkeys(("date_id", "year", "month", "quarter", "week"), IntegerType()),
    "is_weekend": IntegerType(),
}


def _table_type(table: str, column: str) -> DataType:
    if table == "dim_date":
        return DIM_DATE_TYPES.get(column, StringType())
    if table in ROLLUP_TABLES and column not in (*COLUMN_TYPES, *TEXT_COLUMNS):
        return LongType() if column in WHOLE_FIGURES else DoubleType()
    if table in ROLLUP_TABLES and column == "revenue_at_risk":
        return DoubleType()
    return COLUMN_TYPES.get(column, StringType())


# Contracts of the ten warehouse tables. Amounts may be kept in a narrower DECIMAL than the declared one.
TABLE_SCHEMAS: dict[str, StructType] = {
    table: StructType([StructField(c, _table_type(table, c)) for c in columns]) for table, columns in TABLE_COLUMNS.items()
}

RUN_LOG = StructType(
    [
        StructField("run_id", LongType(), False),
        StructField("run_timestamp", TimestampType(), False),
        StructField("status", StringType(), False),
        StructField("rows_processed", LongType()),
        StructField("rows_inserted", LongType()),
        StructField("source_table", StringType()),
        StructField("duration_secs", DoubleType()),
        StructField("error_message", StringType()),
    ]
)
# A missing quantity is filled with the median, which may be a half.
CLEAN_QUANTITY = DecimalType(11, 1)


def struct_of(columns, dates_as_text: bool = False) -> StructType:
    """The contract of a cleaned table as a StructType."""
    fields = []
    for name in columns:
        dtype = COLUMN_TYPES.get(name, StringType())
        if dates_as_text and isinstance(dtype, TimestampType):
            dtype = StringType()
        if name == "quantity":
            dtype = CLEAN_QUANTITY
        fields.append(StructField(name, dtype))
    return StructType(fields)
