"""Star schema: five dimensions, the order fact, and the joins between them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from orderloom.functions.dates import date_key, day_name, is_weekend, month_name
from orderloom.operators.keys import keep_first, number_rows
from orderloom.schemas import AMOUNT_COLUMNS, ANY_NUMBER, FACT_COLUMNS, FLAG_COLUMNS, GEO_COLUMNS, MONEY

Tables = Mapping[str, DataFrame]


def _plain_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def dim_customers(customers: DataFrame) -> DataFrame:
    customers = _plain_headers(customers)
    rows = keep_first(customers, "customer_id", [], customers.columns)
    return rows.withColumn("customer_id", F.col("customer_id").cast("bigint"))


def dim_products(products: DataFrame) -> DataFrame:
    products = _plain_headers(products)
    rows = keep_first(products, "product_id", [], products.columns)
    return rows.withColumn("product_id", F.col("product_id").cast("bigint"))


def dim_suppliers(orders: DataFrame) -> DataFrame:
    """Departments act as suppliers; ids 1..n by department id and name."""
    names = ["department_id", "department_name"]
    rows = orders.select(*names).distinct().dropna()
    numbered = number_rows(rows, [F.col(c) for c in names], [F.floor(F.col("department_id") / 64)])
    return numbered.select(F.col("_number").alias("supplier_id"), *names)


def dim_date(orders: DataFrame) -> DataFrame:
    """One row per order day. Days are made distinct first, so the calendar columns cost nothing."""
    days = orders.select(F.to_date("order_date").alias("date")).where(F.col("date").isNotNull()).distinct()
    d = F.col("date")
    return days.select(
        date_key(d).alias("date_id"),
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        month_name(d).alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.weekofyear(d).alias("week"),
        day_name(d).alias("day_of_week"),
        is_weekend(d).alias("is_weekend"),
    )


def dim_geography(orders: DataFrame) -> DataFrame:
    """Distinct complete places; ids 1..n in the order of the five columns."""
    columns = [c for c in GEO_COLUMNS if c in orders.columns]
    rows = orders.select(*columns).distinct().dropna()
    # Buckets follow the sort order: country, then the first two letters of the city.
    buckets: list[Column] = [F.col(c) for c in columns if c in GEO_COLUMNS[:3]]
    if "order_city" in columns:
        buckets.append(F.left("order_city", F.lit(2)))
    numbered = number_rows(rows, [F.col(c) for c in columns], buckets)
    return numbered.select(F.col("_number").alias("geo_id"), *columns)


def build_dimensions(orders: DataFrame, customers: DataFrame, products: DataFrame) -> dict[str, DataFrame]:
    return {
        "dim_customers": dim_customers(customers),
        "dim_products": dim_products(products),
        "dim_suppliers": dim_suppliers(orders),
        "dim_date": dim_date(orders),
        "dim_geography": dim_geography(orders),
    }


def with_date_key(orders: DataFrame) -> DataFrame:
    """``date_id`` of the order date; null for a null date."""
    return orders.withColumn("date_id", date_key(F.col("order_date")))


def with_supplier_key(orders: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Left join on the department; a null column when the key is not there at all.

    ``suppliers`` must hold one row per department, see ``quality.key_violations``.
    No broadcast hint: Spark broadcasts below its own size threshold and otherwise runs a
    sort-merge join whose hot keys are split.
    """
    if "department_id" not in orders.columns or "department_id" not in suppliers.columns:
        return orders.withColumn("supplier_id", F.lit(None).cast("bigint"))
    return orders.join(suppliers.select("supplier_id", "department_id"), "department_id", "left")


def with_geo_key(orders: DataFrame, geography: DataFrame) -> DataFrame:
    """Left join on the shared place columns; a null column when there are none."""
    columns = [c for c in GEO_COLUMNS if c in orders.columns and c in geography.columns]
    if not columns:
        return orders.withColumn("geo_id", F.lit(None).cast("bigint"))
    return orders.join(geography.select("geo_id", *columns), columns, "left")


def coerce_fact_types(df: DataFrame) -> DataFrame:
    """Flags and amounts become numbers; unreadable and missing ones become 0. A flag may be written ``1.0``."""
    fixed = {}
    for c in FLAG_COLUMNS:
        if c in df.columns:
            number = F.col(c) if isinstance(df.schema[c].dataType, IntegralType) else F.col(c).try_cast(ANY_NUMBER)
            fixed[c] = F.coalesce(number.try_cast("int"), F.lit(0))
    for c in AMOUNT_COLUMNS:
        if c in df.columns:
            dtype = df.schema[c].dataType
            target = MONEY if isinstance(dtype, StringType) else dtype
            fixed[c] = F.coalesce(F.col(c).try_cast(target), F.lit(0).cast(target))
    return df.withColumns(fixed)


def build_fact(orders: DataFrame, suppliers: DataFrame, geography: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Order lines with dimension keys, 33 columns, and the ``extra`` ones."""
    keyed = with_geo_key(with_supplier_key(with_date_key(_plain_headers(orders)), suppliers), geography)
    return coerce_fact_types(keyed.select(*[c for c in (*FACT_COLUMNS, *extra) if c in keyed.columns]))


# dimension -> (fact foreign key, columns the report base takes from it)
REPORT_ATTRIBUTES: dict[str, tuple[str, Sequence[str]]] = {
    "dim_date": ("date_id", ("year", "month", "month_name", "quarter")),
    "dim_geography": ("geo_id", ("market", "order_region", "order_country")),
    "dim_customers": ("customer_id", ("segment",)),
    "dim_products": ("product_id", ("category", "product_name")),
    "dim_suppliers": ("supplier_id", ("department_name",)),
}


def star_join(star: Tables, attributes: Sequence[str] | None = None, corrections: Tables = {}) -> DataFrame:
    """The fact with report attributes from the dimensions, every fact row kept.

    By default all eleven attributes; a report that names the ones it uses skips the
    joins to the other dimensions. Where ``corrections`` of a dimension are given, see :func:`line_corrections`, the
    rows of the fact bear its attributes already, and only the rows of corrected keys take them from there.
    """
    base = star["fact_orders"]
    taken: list[str] = []
    for dim, (key, offered) in REPORT_ATTRIBUTES.items():
        wanted = [c for c in offered if attributes is None or c in attributes]
        if not wanted:
            continue
        if dim in corrections:
            base = _corrected(base, corrections[dim], key, wanted)
        else:
            base = base.join(star[dim].select(key, *wanted), key, "left")
        taken += wanted
    return base.select(*FACT_COLUMNS, *taken)


#: Dimensions that grow with the lines; the others are small, and Spark broadcasts them.
LARGE_DIMENSIONS = ("dim_customers", "dim_products")


def line_corrections(lines: DataFrame, dim: DataFrame, name: str) -> DataFrame | None:
    """``key`` and attributes of the dimension rows that differ from what some line of that key says itself.

    Lines hold the attributes that their dimension rows were taken from. Only keys whose lines contradict one another, or a
    row of an earlier batch, are returned, so lines need not be shuffled to meet a large dimension. None where the lines
    don't hold the attributes in the types of the dimension.
    """
    key, attributes = REPORT_ATTRIBUTES[name]
    here = {f.name: f.dataType for f in lines.schema.fields}
    if not isinstance(here.get(key), IntegralType) or any(here.get(c) != dim.schema[c].dataType for c in attributes):
        return None
    said = lines.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in attributes]).distinct()
    known = said.join(dim.select(key, *attributes), F.col("_key") == F.col(key), "left")
    differs = reduce(or_, [~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in attributes])
    return known.where(differs).select(F.col("_key").alias(key), *attributes).distinct()


def _corrected(rows: DataFrame, corrections: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Attributes of the rows, those of corrected keys from there; null for a null key, which refers to nothing."""
    known = corrections.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in attributes])
    both = rows.join(known, F.col(key) == F.col("_key"), "left")
    values = {c: F.when(F.col("_key").isNotNull(), F.col(f"_{c}")).when(F.col(key).isNotNull(), F.col(c)) for c in attributes}
    return both.withColumns(values).drop("_key", *[f"_{c}" for c in attributes])


def bearing_rows(lines: DataFrame, dim: str, corrections: DataFrame, like: DataFrame) -> DataFrame:
    """The fact rows of ``lines`` that refer to a row of a large dimension, in the types of the fact ``like``, with the
    dimension's attributes: what the inner join of the fact with the dimension gives, without shuffling the fact for it."""
    key, attributes = REPORT_ATTRIBUTES[dim]
    plain = coerce_fact_types(_plain_headers(lines).where(F.col(key).isNotNull()))
    typed = plain.select(*[F.col(f.name).cast(f.dataType) for f in like.schema.fields if f.name in plain.columns and f.name not in attributes], *attributes)
    return _corrected(typed, corrections, key, attributes)


def supplier_products(orders: DataFrame) -> DataFrame:
    """One row per department and product, with the first name, region and market."""
    columns = ["department_id", "department_name", "product_id", "order_region", "market"]
    pair = F.struct("department_id", "product_id").alias("pair")
    rows = orders.select(pair, *columns, "order_item_id")
    first = keep_first(rows, "pair", ["order_item_id"], ["pair", "department_name", "order_region", "market"])
    return first.select(
        F.col("pair.department_id").alias("department_id"),
        "department_name",
        F.col("pair.product_id").alias("product_id"),
        "order_region",
        "market",
    )
