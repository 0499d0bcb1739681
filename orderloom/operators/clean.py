"""Cleaning of raw order lines: nulls, dates, names, text, split into three tables."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, DecimalType, IntegerType, IntegralType, NumericType, ShortType, StringType

from orderloom.functions.dates import day_name, parse_timestamp
from orderloom.functions.text import standard_text
from orderloom.operators.derive import order_flags
from orderloom.operators.keys import keep_first
from orderloom.operators.median import approximate_medians, median_values
from orderloom.schemas import (
    COLUMN_TYPES,
    CUSTOMER_COLUMNS,
    ORDER_COLUMNS,
    PRODUCT_COLUMNS,
    RAW_DATE_FORMATS,
    RAW_DATES,
    RAW_RENAMES,
    TEXT_COLUMNS,
)

UNKNOWN = "Unknown"


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def fill_numeric_median(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Null numbers become the median of their column; an all-null column stays null.

    Only columns with nulls change. Of those, integer and decimal columns widen by one decimal place, so that
    a midpoint fits exactly, and by as many digits as that takes.
    """
    columns = list(columns) if columns is not None else numeric_columns(df)
    if not columns:
        return df
    if exact:
        medians = median_values(df, columns, incomplete_only=True)
    else:
        medians = {r["column"]: r["median"] for r in approximate_medians(df, columns).collect()}
    filled = {}
    for c, median in medians.items():
        if median is not None:
            target = _with_midpoint(df.schema[c].dataType)
            value = F.lit(format(median, "f") if isinstance(median, Decimal) else median)
            filled[c] = F.coalesce(F.col(f"`{c}`").cast(target), value.cast(target))
    return df.withColumns(filled) if filled else df


def _with_midpoint(dtype: DataType) -> DataType:
    """A type that holds all values of the given one, and halves of them."""
    if isinstance(dtype, IntegralType):
        return DecimalType({ByteType: 4, ShortType: 6, IntegerType: 11}.get(type(dtype), 20), 1)
    if isinstance(dtype, DecimalType) and dtype.precision < 38:
        return DecimalType(dtype.precision + 1, dtype.scale + 1)
    return dtype


def fill_text_unknown(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null text becomes ``Unknown``."""
    return df.fillna(UNKNOWN, subset=list(columns) if columns is not None else text_columns(df))


def fill_nulls(df: DataFrame, exact: bool = True) -> DataFrame:
    return fill_text_unknown(fill_numeric_median(df, exact=exact))


def parse_dates(df: DataFrame, formats: Sequence[str] = RAW_DATE_FORMATS) -> DataFrame:
    """The raw date texts that are there become timestamps under their clean names; unreadable ones null."""
    for raw, name in RAW_DATES.items():
        if raw in df.columns:
            df = df.withColumn(name, parse_timestamp(F.col(f"`{raw}`"), formats)).drop(raw)
    return df


def date_parts(df: DataFrame) -> DataFrame:
    """Year, month, quarter and full English day name of the order date."""
    return df.withColumns(
        {
            "order_year": F.year("order_date"),
            "order_month": F.month("order_date"),
            "order_quarter": F.quarter("order_date"),
            "order_dow": day_name(F.col("order_date")),
        }
    )


def rename_columns(df: DataFrame) -> DataFrame:
    """Snake-case names for the known headers that are there; blanks around headers do not matter."""
    df = df.withColumnsRenamed({c: c.strip() for c in df.columns if c != c.strip()})
    return df.withColumnsRenamed({k: v for k, v in RAW_RENAMES.items() if k in df.columns})


def standardize_text(df: DataFrame, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """Strip and title-case the category columns that are there."""
    return df.withColumns({c: standard_text(F.col(c)) for c in columns if c in df.columns})


def clean_lines(df: DataFrame, formats: Sequence[str] = RAW_DATE_FORMATS, exact: bool = True) -> DataFrame:
    """Raw lines to clean lines. Nulls are filled first, so a missing date text ends as a null date."""
    df = rename_columns(date_parts(parse_dates(fill_nulls(df, exact), formats)))
    return order_flags(standardize_text(df))


def split_orders(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in ORDER_COLUMNS if c in df.columns])


def split_customers(df: DataFrame) -> DataFrame:
    """One row per customer: the payload of the first order line."""
    return keep_first(df, "customer_id", ["order_item_id"], [c for c in CUSTOMER_COLUMNS if c in df.columns])


def split_products(df: DataFrame) -> DataFrame:
    """One row per product: the payload of the first order line."""
    return keep_first(df, "product_id", ["order_item_id"], [c for c in PRODUCT_COLUMNS if c in df.columns])


def narrow_types(df: DataFrame) -> DataFrame:
    """Back to integers where filling medians widened an integer key, count or flag.

    Only columns whose values are whole by nature are narrowed; a quantity filled with a
    half stays a decimal.
    """
    whole = [c for c, t in COLUMN_TYPES.items() if isinstance(t, IntegralType) and c != "quantity" and c in df.columns]
    return df.withColumns({c: F.col(c).cast(COLUMN_TYPES[c]) for c in whole})
