"""Readers: raw and clean CSV files, processed tables, SQL over the warehouse, run history."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, FractionalType, IntegralType, NumericType, StringType, StructType, TimestampType

from orderloom.schemas import (
    ANY_NUMBER,
    CLEAN_DATE_FORMAT,
    COLUMN_TYPES,
    CUSTOMER_COLUMNS,
    ORDER_COLUMNS,
    PROCESSED_TABLES,
    PRODUCT_COLUMNS,
    RAW_RENAMES,
    RUN_LOG,
    struct_of,
)
from orderloom.sources.records import read_records

# Texts that mean "no value" in a CSV field.
MISSING = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def _open(read, path: str) -> DataFrame:
    try:
        return read(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise FileNotFoundError(f"no table at {path}") from e
        raise


def read_raw_text(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """The fields of a raw Latin-1 CSV with a header, as text. Fields with line breaks need ``multiline``, see
    :mod:`orderloom.sources.records`; files are split in either case."""
    if multiline:
        return _open(lambda p: read_records(spark, p), path)
    reader = (
        spark.read.option("header", True)
        .option("encoding", "ISO-8859-1")
        .option("escape", '"')
    )
    return _open(reader.csv, path)


def read_raw_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Raw order lines; known columns get their type by name.

    No inference pass: every field is read as text and converted in the same scan. Column
    order and extra columns do not matter, blanks around headers are dropped. Whole numbers may be
    written with a fraction of zero (``3.0``). Text that is no number becomes null, see
    :func:`unreadable_numbers`; a number that does not fit its column is an error.
    """
    text = read_raw_text(spark, path, multiline)
    return text.select(*[_typed(c) for c in text.columns])


def unreadable_numbers(text: DataFrame) -> DataFrame:
    """Rows ``(column, n_unreadable)`` for every number column of raw text: fields that hold something, but no number."""
    columns = {h.strip(): h for h in text.columns if _is_number(_column_type(h.strip()))}
    if not columns:
        return text.sparkSession.createDataFrame([], "column string, n_unreadable bigint")
    bad = {n: F.count_if(_value(h).isNotNull() & _typed(h).isNull()).alias(n) for n, h in columns.items()}
    return text.agg(*bad.values()).unpivot([], [f"`{n}`" for n in bad], "column", "n_unreadable")


def _column_type(name: str) -> DataType:
    return COLUMN_TYPES.get(RAW_RENAMES.get(name, ""), StringType())


def _is_number(dtype: DataType) -> bool:
    return isinstance(dtype, NumericType)


def _value(header: str) -> Column:
    field = F.col(f"`{header}`")
    return F.when(~field.isin(*MISSING), field)


def _typed(header: str) -> Column:
    name = header.strip()
    value, dtype = _value(header), _column_type(name)
    if not _is_number(dtype) or isinstance(dtype, FractionalType) and not isinstance(dtype, DecimalType):
        return (value if isinstance(dtype, StringType) else value.try_cast(dtype)).alias(name)
    number = value.try_cast(ANY_NUMBER)
    digits = value.try_cast(DecimalType(38, 0))
    if isinstance(dtype, IntegralType):
        number = digits = F.when(number % F.lit(1) == 0, digits)
        fitted = digits.try_cast(dtype)
    else:
        fitted = value.try_cast(dtype)
    lost = F.raise_error(F.concat(F.lit(f"{name} does not fit its type: "), value)).cast(dtype)
    # What fits is not read a second time to see whether it is a number.
    return F.when(fitted.isNull() & F.coalesce(number, digits).isNotNull(), lost).otherwise(fitted).alias(name)


def read_clean_csvs(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The three cleaned tables from CSV, with declared types and parsed timestamps."""
    tables = {"orders": ORDER_COLUMNS, "customers": CUSTOMER_COLUMNS, "products": PRODUCT_COLUMNS}
    reader = spark.read.option("header", True).option("enforceSchema", False).option("escape", '"')
    found = {}
    for name, columns in tables.items():
        # A headerless or missing folder fails on open, a wrong header when rows are read.
        df = _open(reader.schema(struct_of(columns, dates_as_text=True)).csv, f"{folder}/{name}_clean")
        found[name] = parse_clean_timestamps(df)
    return found


def parse_clean_timestamps(df: DataFrame) -> DataFrame:
    """Order and ship date of a cleaned file as timestamps; unreadable text becomes null."""
    dates = [c for c, t in COLUMN_TYPES.items() if isinstance(t, TimestampType) and c in df.columns]
    return df.withColumns({c: F.try_to_timestamp(c, F.lit(CLEAN_DATE_FORMAT)) for c in dates})


def read_tables(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Parquet tables by name; all missing ones are reported together before any work starts."""
    found, missing = {}, []
    for name in names:
        try:
            found[name] = _open(spark.read.parquet, f"{folder}/{name}")
        except FileNotFoundError:
            missing.append(name)
    if missing:
        raise FileNotFoundError(f"missing in {folder}: {', '.join(missing)}")
    return found


def read_processed(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The seven processed tables."""
    return read_tables(spark, folder, PROCESSED_TABLES)


def query_tables(spark: SparkSession, tables: Mapping[str, DataFrame], sql: str) -> DataFrame:
    """Any SELECT over the given tables, by their names, without registering a view."""
    return spark.sql(sql, **{name: tables[name] for name in tables if "{" + name + "}" in sql})


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make the tables known to ``spark.sql`` by name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_history(spark: SparkSession, path: str) -> DataFrame:
    """Pipeline runs, newest first."""
    log: StructType = RUN_LOG
    return _open(spark.read.schema(log).parquet, path).orderBy(F.desc("run_id"))
