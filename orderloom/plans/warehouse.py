"""The batch jobs: clean order lines in, written star schema and rollups out.

Every batch of lines, the first load included, is written once and read back before
anything else uses it. That cuts the lineage at a table that survives a lost executor,
gives Spark real sizes for its join choices, and lets every KPI read a few columns of one
fact instead of repeating the joins below it.

A warehouse folder holds versions, see ``sources.snapshots``: ``lines`` (by batch), the report base (by batch,
order year and market), of which ``fact_orders`` is the first columns, ``rollup_cube``, ``supplier_products`` and the parts of the KPIs (by batch), five dimensions, four rollups. The
log ``pipeline_runs`` lies beside them.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators import star as st
from orderloom.operators.clean import clean_lines, date_parts, narrow_types, split_customers, split_orders, split_products
from orderloom.operators.derive import enrich_orders
from orderloom.operators.keys import number_rows
from orderloom.operators.profile import profile_of, profile_values
from orderloom.operators.quality import batch_quality
from orderloom.plans import checks, kpis
from orderloom.operators.parts import DISTINCTS, PARTS, STORED, Warehouse, batch_distincts, batch_parts, united
from orderloom.plans.reports import REPORT_BASE, report_filter
from orderloom.plans.rollups import (
    refreshed_from_cube,
    rollup_cube,
    rollups,
    rollups_from_cube,
    supplier_product_pairs,
)
from orderloom.schemas import CUSTOMER_COLUMNS, FACT_COLUMNS, GEO_COLUMNS, PRIMARY_KEYS, PRODUCT_COLUMNS, WAREHOUSE_TABLES
from orderloom.session import drop_path, fresh_path, run_together
from orderloom.sources.readers import read_raw_csv, read_raw_text, read_tables, unreadable_numbers
from orderloom.sources.snapshots import BATCH, Changes, newest, open_tables, put_orders
from orderloom.sources.writers import FIRST_BATCH, check_contract, export_refreshed, log_run, save_kpis, write_table

RUN_LOG_TABLE = "pipeline_runs"
UNREADABLE, PROFILE = "unreadable_numbers", "profile_values"
#: Fact rows that one task sorts and writes, a file for each year and market; under half a GB in memory.
ROWS_OF_A_TASK = 1_000_000
KPI_GROUPINGS = united([*kpis.GROUPINGS.values(), *checks.GROUPINGS.values()])


def build_warehouse(spark: SparkSession, lines: DataFrame, folder: str) -> dict[str, DataFrame]:
    """First load; replaces what the folder holds. ``lines`` are wide clean order lines with customer
    and product columns."""
    with Changes(spark, folder, afresh=True) as new:
        _first_load(new, lines)
        new.publish()
    return open_warehouse(spark, folder)


def _first_load(new: Changes, lines: DataFrame) -> None:
    wide, _ = _put_lines(new, enrich_orders(date_parts(lines)), str(FIRST_BATCH))
    dims = st.build_dimensions(split_orders(wide), split_customers(wide), split_products(wide))
    run_together([*_puts(new, dims), *_part_puts(new, wide, str(FIRST_BATCH))])
    _put_fact(new, wide, str(FIRST_BATCH))


def first_lines(lines: DataFrame) -> DataFrame:
    """The enriched lines of a first load as a warehouse would store them, with nothing written, for work that reads no other
    table of it."""
    wide = enrich_orders(date_parts(lines))
    columns = {c: F.col(c) for c in wide.columns if c != BATCH} | {BATCH: F.lit(str(FIRST_BATCH))}
    # A condition without an "otherwise", always true: every column may be null, as in a stored table.
    always = F.lit(1) == 1
    return wide.select(*[F.when(always, column).alias(c) for c, column in columns.items()])


def open_warehouse(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of the newest version of a warehouse, the wide ``lines`` they came from, the ``report_base`` and the
    stored parts of the KPIs. They stay as they are while later batches are added."""
    return Warehouse(open_tables(spark, folder, newest(spark, folder), [*WAREHOUSE_TABLES, "lines", REPORT_BASE, *STORED]))


def append_lines(spark: SparkSession, folder: str, batch: DataFrame, batch_id: str) -> tuple[int, int]:
    """Add one batch of order lines to a warehouse and bring its rollups up to date.

    All derived columns and keys are computed for the new lines; days, places, suppliers,
    customers and products that are new get their dimension rows. Returns (rows read, rows
    added to the fact). Work grows with the batch, not with the fact: the rollups are
    merged from the cubes of all batches. Repeating a batch id replaces that batch. Lines of types
    that the stored ones cannot hold are refused before anything is written. All tables change at once, with the
    version that is published last; after an error, or next to another writer who was first, nothing has changed.
    """
    with Changes(spark, folder) as new:
        counts = _append(new, batch, batch_id)
        new.publish()
    return counts


def _append(new: Changes, batch: DataFrame, batch_id: str) -> tuple[int, int]:
    if not isinstance(batch_id, str) or batch_id.isdigit():
        raise ValueError("a batch id names its source, such as daily-7; number 0 is the first load")
    if not new.tables:
        raise FileNotFoundError(f"no warehouse in {new.folder}")
    wide, read = _put_lines(new, enrich_orders(date_parts(batch)), batch_id)
    _extend_dimensions(new, wide, batch_id)
    run_together(_part_puts(new, wide, batch_id))
    return read, _put_fact(new, wide, batch_id)


def run_batch(
    spark: SparkSession,
    folder: str,
    batch: DataFrame | Callable[[Changes], DataFrame],
    batch_id: str,
    export_folder: str | None,
) -> None:
    """Append, refresh, export, log. A failure is logged as FAILED and raised again.

    Exported are the new batch's fact rows and the refreshed monthly and regional figures. ``batch`` may be a function
    that reads the lines; what it stages is published with the batch, and its failure is logged like any other.
    """
    started, log = time.monotonic(), f"{folder}/{RUN_LOG_TABLE}"
    read = added = 0
    try:
        with Changes(spark, folder) as new:
            read, rows = _append(new, batch(new) if callable(batch) else batch, batch_id)
            new.publish()
        added = rows
        if export_folder:
            facts = new.batch("fact_orders", batch_id)
            export_refreshed(spark, {"fact_orders": facts, **refreshed_from_cube(*_parts(new))}, export_folder)
    except Exception as e:
        log_run(spark, log, "FAILED", read, added, "fact_orders", time.monotonic() - started, str(e))
        raise
    log_run(spark, log, "SUCCESS", read, added, "fact_orders", time.monotonic() - started)


def run_daily(spark: SparkSession, folder: str, batch: DataFrame, batch_id: int, export_folder: str | None) -> None:
    """The daily cycle over clean order lines."""
    run_batch(spark, folder, batch, f"daily-{batch_id}", export_folder)


def run_daily_file(spark: SparkSession, folder: str, raw_path: str, batch_id: int, export_folder: str | None) -> None:
    """The daily cycle from a raw CSV file: read, clean, append, refresh, export, log.

    Fields that hold something but no number are counted in the table ``unreadable_numbers``. A file that cannot be read or
    holds a number that does not fit is a FAILED run in the log. Nulls are filled from the file alone.
    """
    name, aside = f"daily-{batch_id}", fresh_path(spark, "daily-lines")

    def lines(new: Changes) -> DataFrame:
        new.put_batch(UNREADABLE, unreadable_numbers(read_raw_text(spark, raw_path)), name)
        write_table(narrow_types(clean_lines(read_raw_csv(spark, raw_path))), aside)
        return spark.read.parquet(aside)

    try:
        run_batch(spark, folder, lines, name, export_folder)
    finally:
        drop_path(spark, aside)


def store_profile(spark: SparkSession, folder: str, raw: DataFrame, batch_id: str) -> None:
    """Keep the different values of a batch of raw lines; the profile of all batches is read off them."""
    with Changes(spark, folder) as new:
        new.put_batch(PROFILE, profile_values(raw), batch_id)
        new.publish()


def stored_profile(spark: SparkSession, folder: str) -> DataFrame:
    """The profile of all batches of raw lines that were stored; no raw line is read again."""
    return profile_of(open_tables(spark, folder, newest(spark, folder), [PROFILE])[PROFILE])


def processed_tables(lines: DataFrame) -> dict[str, DataFrame]:
    """Enriched orders, customers, products and the four rollups, from wide clean lines."""
    orders = enrich_orders(split_orders(lines))
    return {
        "orders": orders,
        "customers": split_customers(lines),
        "products": split_products(lines),
        **rollups(orders),
    }


def run_etl(spark: SparkSession, raw_path: str, folder: str) -> dict[str, DataFrame]:
    """Raw CSV to warehouse. Fields that hold something but no number are counted in ``unreadable_numbers``."""
    aside = fresh_path(spark, "lines-clean")
    try:
        with Changes(spark, folder, afresh=True) as new:
            new.put_batch(UNREADABLE, unreadable_numbers(read_raw_text(spark, raw_path)), FIRST_BATCH)
            write_table(narrow_types(clean_lines(read_raw_csv(spark, raw_path))), aside)
            _first_load(new, spark.read.parquet(aside))
            new.publish()
    finally:
        drop_path(spark, aside)
    return open_warehouse(spark, folder)


def run_kpis(spark: SparkSession, star: Mapping[str, DataFrame], folder: str) -> dict[str, int]:
    """Compute all KPIs with one fact pass per grouping and write each as a CSV result."""
    parts = fresh_path(spark, "kpi-parts")

    folded = kpis.shared_parts(star)
    run_together(_writes(folded, parts))
    saved = save_kpis(kpis.results_from_parts(read_tables(spark, parts, folded)), folder)
    drop_path(spark, parts)
    return saved


def _writes(tables: Mapping[str, DataFrame], folder: str) -> list[Callable[[], int]]:
    return [partial(write_table, df, f"{folder}/{name}") for name, df in tables.items()]


def _puts(new: Changes, tables: Mapping[str, DataFrame]) -> list[Callable[[], int]]:
    return [partial(new.put, name, df) for name, df in tables.items()]


def _put_lines(new: Changes, wide: DataFrame, batch_id: str) -> tuple[DataFrame, int]:
    """The lines of a batch as they are stored, and their number. Nothing reads them by year, so no task sorts them by it."""
    rows = new.put_batch("lines", wide, batch_id)
    return new.batch("lines", batch_id).select(*wide.columns), rows


def _part_puts(new: Changes, wide: DataFrame, batch_id: str) -> list[Callable[[], int]]:
    """What the rollups need to know of a batch."""
    parts = {"rollup_cube": rollup_cube(wide), "supplier_products": supplier_product_pairs(wide)}
    return [partial(new.put_batch, name, df, batch_id) for name, df in parts.items()]


def _parts(new: Changes) -> tuple[DataFrame, DataFrame]:
    stored = new.read("rollup_cube", "supplier_products")
    return stored["rollup_cube"], stored["supplier_products"]


def _put_fact(new: Changes, wide: DataFrame, batch_id: str) -> int:
    """The fact rows of a batch and all that is kept current with them; returns their number."""
    dims = new.read(*PRIMARY_KEYS)
    aside = fresh_path(new.spark, "corrections")
    known = _corrections(new.spark, wide, dims, aside)
    fresh = rollups_from_cube(*_parts(new))
    added = run_together([partial(_put_base, new, wide, dims, known, batch_id), *_puts(new, fresh)])[0]
    drop_path(new.spark, aside)
    base = new.batch(REPORT_BASE, batch_id)
    star = {**dims, "fact_orders": new.batch("fact_orders", batch_id)}
    # Every key that lines hold has its row in a dimension that is made from them.
    bearing = {d: base.where(F.col(st.REPORT_ATTRIBUTES[d][0]).isNotNull()) for d in known}
    parts = {PARTS: batch_parts(star, KPI_GROUPINGS, bearing), DISTINCTS: batch_distincts(star, KPI_GROUPINGS, bearing)}
    parts |= batch_quality(star["fact_orders"], report_filter(base))
    run_together([partial(new.put_batch, n, df, batch_id) for n, df in parts.items()])
    return added


def _corrections(spark: SparkSession, wide: DataFrame, star: Mapping[str, DataFrame], aside: str) -> dict[str, DataFrame]:
    """Lines say themselves what the large dimensions say of their keys. What differs is written first, so that Spark knows
    how little it is and broadcasts it; the lines are shuffled only where it is much."""
    found = {d: st.line_corrections(wide, star[d], d) for d in st.LARGE_DIMENSIONS}
    found = {d: df for d, df in found.items() if df is not None}
    run_together(_writes(found, aside))
    return {d: spark.read.schema(df.schema).parquet(f"{aside}/{d}") for d, df in found.items()}


def _put_base(new: Changes, wide: DataFrame, dims: Mapping[str, DataFrame], known: Mapping[str, DataFrame], batch_id: str) -> int:
    """The fact rows of a batch, joined to all dimensions once, for every page to read. They are written once: the fact is
    their first columns. Rows without a year, market, segment or category are held as well; no report filter lets them pass.
    A task takes up to ``ROWS_OF_A_TASK`` of them where there are enough for all cores, so that its files are not too small."""
    said = [c for d in known for c in st.REPORT_ATTRIBUTES[d][1]]
    fact = st.build_fact(wide, dims["dim_suppliers"], dims["dim_geography"], said)
    rows = st.star_join({**dims, "fact_orders": fact.select(*check_contract(fact, "fact_orders").columns, *said)}, corrections=known)
    tasks = max(new.spark.sparkContext.defaultParallelism, -(-new.rows("lines", batch_id) // ROWS_OF_A_TASK))
    added = put_orders(new, REPORT_BASE, rows.coalesce(tasks), batch_id, cluster_by=["market", "category"])
    new.share_batch("fact_orders", REPORT_BASE, batch_id, FACT_COLUMNS)
    return added


def _extend_dimensions(new: Changes, wide: DataFrame, batch_id: str) -> None:
    """Append the dimension rows that a batch needs and the warehouse does not have yet."""
    dims = new.read(*PRIMARY_KEYS)
    rows = {
        "dim_date": _unseen(st.dim_date(wide), dims["dim_date"], ["date_id"]),
        "dim_geography": _numbered_on(
            _unseen(st.dim_geography(wide), dims["dim_geography"], GEO_COLUMNS), dims["dim_geography"], "geo_id"
        ),
        "dim_suppliers": _numbered_on(
            _unseen(st.dim_suppliers(wide), dims["dim_suppliers"], ["department_id"]), dims["dim_suppliers"], "supplier_id"
        ),
    }
    if set(CUSTOMER_COLUMNS) <= set(wide.columns):
        rows["dim_customers"] = _unseen(st.dim_customers(split_customers(wide)), dims["dim_customers"], ["customer_id"])
    if set(PRODUCT_COLUMNS) <= set(wide.columns):
        rows["dim_products"] = _unseen(st.dim_products(split_products(wide)), dims["dim_products"], ["product_id"])
    run_together([partial(new.add, name, df, batch_id) for name, df in rows.items()])


def _unseen(rows: DataFrame, dim: DataFrame, keys) -> DataFrame:
    return rows.join(dim.select(*keys), list(keys), "left_anti")


def _numbered_on(rows: DataFrame, dim: DataFrame, id_column: str) -> DataFrame:
    """Ids that continue after the largest one in use, in the order of the batch's own ids."""
    last = dim.select(F.coalesce(F.max(id_column), F.lit(0))).scalar()
    numbered = number_rows(rows, [F.col(id_column)], [F.floor(F.col(id_column) / 4096)])
    return numbered.withColumn(id_column, last + F.col("_number")).drop("_number")
