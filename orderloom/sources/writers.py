"""Writers: tables, KPI results, CSV exports, fact appends, the run log, read-back checks.

Row counts come from observed metrics of the write itself, not from a second scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    IntegerType,
    IntegralType,
    LongType,
    NumericType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from orderloom.schemas import CLEAN_DATE_FORMAT, FACT_COLUMNS, REFRESHED_TABLES, RUN_LOG, TABLE_SCHEMAS, WAREHOUSE_TABLES, YEAR
from orderloom.session import drop_path, run_together
from orderloom.sources.files import beside, create_whole, put_in_place

CSV_FORMAT = {
    "header": "true",
    "escape": '"',
    "timestampFormat": CLEAN_DATE_FORMAT,
    # Blanks at either end belong to the value.
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Iterable[str] = ()) -> int:
    """Write Parquet and return the number of rows written."""
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    observed.write.mode(mode).option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return seen.get["rows"]


def write_csv(df: DataFrame, path: str, single_file: bool = False, options: Mapping[str, str] | None = None) -> int:
    """Write CSV with a header and return the number of rows. ``single_file`` is for results
    that are small by definition; tables keep their partitions. The files are written aside and then put in place, so
    readers find the old ones or the new ones."""
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if single_file:
        observed = observed.coalesce(1)
    aside = beside(path)
    try:
        observed.write.options(**CSV_FORMAT, **(options or {})).csv(aside)
        put_in_place(df.sparkSession, aside, path)
    finally:
        drop_path(df.sparkSession, aside)
    return seen.get["rows"]


#: Rows of a compressed CSV file, which one task must read whole.
ROWS_OF_A_CSV_FILE = 200_000


def compressed_csv(codec: str = "gzip") -> dict[str, str]:
    """Options of :func:`write_csv` for files that Spark reads back: less than a quarter of the disk, and each of them is short,
    since it cannot be split."""
    return {"compression": codec, "maxRecordsPerFile": str(ROWS_OF_A_CSV_FILE)}


def save_cleaned(
    orders: DataFrame, customers: DataFrame, products: DataFrame, folder: str, csv: bool = False, options: Mapping[str, str] | None = None
) -> dict[str, int]:
    """Write the three cleaned tables as ``<name>_clean``; ``options`` are those of the CSV files."""
    tables = {"orders_clean": orders, "customers_clean": customers, "products_clean": products}
    write = partial(write_csv, options=options) if csv else write_table
    return dict(zip(tables, run_together([partial(write, df, f"{folder}/{name}") for name, df in tables.items()])))


def save_processed(tables: Mapping[str, DataFrame], folder: str) -> dict[str, int]:
    """Write the processed tables; an error stops the run."""
    return dict(zip(tables, run_together([partial(write_table, df, f"{folder}/{name}") for name, df in tables.items()])))


def save_kpi(df: DataFrame, folder: str, name: str) -> int:
    """Write one KPI result as a single CSV file under its name."""
    return write_csv(df, f"{folder}/{name}", single_file=True)


def save_kpis(results: Mapping[str, DataFrame], folder: str) -> dict[str, int]:
    counts = run_together([partial(save_kpi, df, folder, name) for name, df in results.items()])
    return dict(zip(results, counts))


EXPORT_STATUS = StructType(
    [
        StructField("table_name", StringType(), False),
        StructField("status", StringType(), False),
        StructField("n_rows", LongType()),
        StructField("n_columns", IntegerType()),
        StructField("error", StringType()),
    ]
)


def export_csv(
    spark: SparkSession, tables: Mapping[str, DataFrame], folder: str, names: Iterable[str] = WAREHOUSE_TABLES
) -> DataFrame:
    """Export tables to CSV, one status row each; a failing table is reported and skipped."""

    def export(name: str) -> tuple:
        try:
            df = tables[name]
            if name == "fact_orders":  # without the columns it is stored by
                df = df.select(*FACT_COLUMNS)
            return name, "ok", write_csv(df, f"{folder}/{name}"), len(df.columns), None
        except Exception as e:  # any failure of one table must not stop the others
            return name, "failed", None, None, f"{type(e).__name__}: {e}"

    return spark.createDataFrame(run_together([partial(export, name) for name in names]), EXPORT_STATUS)


def export_refreshed(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str) -> DataFrame:
    """Export only what the daily run changes."""
    return export_csv(spark, tables, folder, REFRESHED_TABLES)


def replace_table(df: DataFrame, path: str) -> int:
    """Replace a table by a finished one: it is written aside first, so a failed write leaves the old table as it was."""
    aside = beside(path)
    rows = write_table(df, aside)
    put_in_place(df.sparkSession, aside, path)
    return rows


def _kind(dtype: DataType) -> str:
    if isinstance(dtype, IntegralType):
        return "whole number"
    if isinstance(dtype, NumericType):
        return "number"
    return "time" if isinstance(dtype, (DateType, TimestampType, TimestampNTZType)) else dtype.simpleString()


def check_contract(df: DataFrame, table: str) -> DataFrame:
    """``df`` in the declared columns of a warehouse table; an error names what is missing or of another kind."""
    faults = []
    for field in TABLE_SCHEMAS[table].fields:
        if field.name not in df.columns:
            faults.append(f"{field.name} is missing")
            continue
        have, want = _kind(df.schema[field.name].dataType), _kind(field.dataType)
        if have != want and (have, want) not in (("whole number", "number"), ("number", "whole number")):
            faults.append(f"{field.name} is {have}, not {want}")
    if faults:
        raise ValueError(f"{table}: {'; '.join(faults)}")
    return df.select(*TABLE_SCHEMAS[table].names)


def conformed(df: DataFrame, stored: StructType, table: str) -> DataFrame:
    """``df`` in the columns and types a table is stored in. What does not fit is an error before anything is written.

    Numbers are cast where no value changes by it: a narrower stored type is checked value by value.
    """
    narrowed, columns = [], []
    for field in stored.fields:
        if field.name not in df.columns:
            raise ValueError(f"{table}: {field.name} is missing")
        have, column = df.schema[field.name].dataType, F.col(f"`{field.name}`")
        if have != field.dataType:
            if not (isinstance(have, NumericType) and isinstance(field.dataType, NumericType)):
                raise ValueError(f"{table}: {field.name} is {have.simpleString()}, the table holds {field.dataType.simpleString()}")
            cast = column.try_cast(field.dataType)
            changed = column.isNotNull() & (cast.isNull() | (cast.cast("decimal(38,9)") != column.cast("decimal(38,9)")))
            narrowed.append(F.count_if(changed).alias(field.name))
            column = cast
        columns.append(column.alias(field.name))
    if narrowed:
        lost = {c: n for c, n in df.agg(*narrowed).first().asDict().items() if n}
        if lost:
            raise ValueError(f"{table}: values that the stored type cannot hold: {lost}")
    return df.select(*columns)


FIRST_BATCH = 0


def write_batch(df: DataFrame, path: str, batch_id: int | str, partition_by: Iterable[str] = ()) -> int:
    """Write one batch of a table that grows by batches and return its number of rows.

    A batch owns the folder ``batch_id=<id>``: writing it again replaces it, so a run that is
    repeated after a failure never adds its rows twice. Ids name their source (``daily-7``,
    ``stream-<query>-7``), so different sources cannot replace each other's batches. Batch 0 is the first load; it
    replaces the whole table and settles the types that later batches are stored in. Rows are written where they are, a
    file for each task and folder; they are not shuffled for fewer files.
    """
    if batch_id == FIRST_BATCH:
        first = df.withColumn("batch_id", F.lit(FIRST_BATCH))
        return write_table(first, path, partition_by=["batch_id", *partition_by])
    stored = df.sparkSession.read.parquet(f"{path}/batch_id={FIRST_BATCH}").schema
    same = conformed(df, stored, path.rsplit("/", 1)[-1])
    return write_table(same, f"{path}/batch_id={batch_id}", partition_by=partition_by)


def write_orders(df: DataFrame, path: str, batch_id: int | str) -> int:
    """Write a batch of order rows, partitioned by order year: a report on some years reads only those."""
    return write_batch(df.withColumn(YEAR, F.year("order_date")), path, batch_id, [YEAR])


def append_fact(batch: DataFrame, path: str, batch_id: int | str) -> int:
    """Append a batch of fact rows (batch 0: replace the fact) and return the number inserted."""
    return write_orders(check_contract(batch, "fact_orders"), path, batch_id)


def log_run(
    spark: SparkSession,
    path: str,
    status: str,
    rows_processed: int,
    rows_inserted: int,
    source_table: str,
    duration_secs: float,
    error_message: str | None = None,
) -> None:
    """Append one run to the log; ids count up from 1.

    An id is taken by creating a file of its name, so two runs that end at once get two ids.
    """
    spark.createDataFrame([], RUN_LOG).write.mode("ignore").parquet(path)
    run_id = (spark.read.schema(RUN_LOG).parquet(path).agg(F.max("run_id")).first()[0] or 0) + 1
    while not create_whole(spark, f"{path}/_ids/{run_id}", status):
        run_id += 1
    now = dt.datetime.now(dt.timezone.utc)
    row = (run_id, now, status, rows_processed, rows_inserted, source_table, round(duration_secs, 2), error_message)
    spark.createDataFrame([row], RUN_LOG).write.mode("append").parquet(path)


def readback(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per saved table: rows, columns, nulls in all columns; one scan each."""
    found = []
    for name, df in tables.items():
        per_column = [F.coalesce(F.count_if(F.col(c).isNull()), F.lit(0)) for c in df.columns]
        row = df.agg(F.count(F.lit(1)).alias("n_rows"), reduce(lambda a, b: a + b, per_column).alias("n_nulls"))
        found.append(
            row.select(
                F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns"), "n_nulls"
            )
        )
    return reduce(DataFrame.unionByName, found)
