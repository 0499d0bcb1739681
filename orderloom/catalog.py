"""Every operator as a named query over the test tables: ``(spark, sf_dir) -> DataFrame``.

Results are published in plain types: money as double, dates as text.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from threading import RLock

from pyspark.errors import AnalysisException, SparkRuntimeException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from orderloom import testdata
from orderloom.functions.rounding import round_half_away
from orderloom.operators import clean, derive, profile, quality, star
from orderloom.plans import batches, checks, kpis, reports, rollups, warehouse
from orderloom.schemas import (
    AMOUNT_COLUMNS,
    ENRICHED_COLUMNS,
    FACT_COLUMNS,
    FLAG_COLUMNS,
    ORDER_COLUMNS,
    PROCESSED_TABLES,
    RAW_DATES,
    REFRESHED_TABLES,
    TEXT_COLUMNS,
    WAREHOUSE_TABLES,
)
from orderloom.session import drop_path, fresh_path, tune
from orderloom.sources import readers, snapshots, writers
from orderloom.streaming.append import append_new_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
LINE = ["order_id", "order_item_id"]

# What a user picks in the report filter in the registered example.
CHOICES = {"years": (1996, 1997, 1998), "markets": ("ASIA", "EUROPE"), "categories": ("LARGE", "PROMO", "SMALL")}


def published(df: DataFrame) -> DataFrame:
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, DateType):
            c = c.cast("string")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: published(fn(tune(spark), sf_dir))
        return fn

    return register


# ── inputs ──

_built: dict[tuple[str, str], dict[str, DataFrame]] = {}
_building = RLock()


def warehouse_of(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The warehouse over the test tables: built and written once per application, then read."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _building:
        if key not in _built:
            lines = testdata.order_lines(spark, sf_dir)
            _built[key] = warehouse.build_warehouse(spark, lines, fresh_path(spark, "warehouse"))
    return _built[key]


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched lines: those of the warehouse where the application has built it, else derived from the joined test tables,
    which are written once, so that queries on lines don't pay for tables and columns they do not read."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _building:
        if key in _built:
            return _built[key]["lines"]
    joined = _stored(spark, sf_dir, "joined", lambda: testdata.joined_tables(spark, sf_dir))
    return warehouse.first_lines(testdata.as_order_lines(joined))


def _dimension(spark: SparkSession, sf_dir: str, name: str, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A dimension made from the lines alone: that of the warehouse where the application has built it, else written once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _building:
        if key in _built:
            return _built[key][name]
        return _stored(spark, sf_dir, name, lambda: make(clean.split_orders(_lines(spark, sf_dir))))


def raw_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw lines, written once per application: in production they are a given file."""
    return _stored(spark, sf_dir, "raw", lambda: testdata.raw_lines(spark, sf_dir))


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw lines cleaned; written once per application, because three tables are split off it."""
    return _stored(spark, sf_dir, "lines-clean", lambda: clean.narrow_types(clean.clean_lines(raw_of(spark, sf_dir))))


_paths: dict[tuple[str, str, str], str] = {}


def _stored(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    with _building:
        if key not in _paths:
            path = fresh_path(spark, name)
            writers.write_table(make(), path)
            _paths[key] = path
    return spark.read.parquet(_paths[key])


def _new_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of new order lines: all lines, one day later."""
    return batches.shift_dates(testdata.order_lines(spark, sf_dir))


def _on_warehouse(fn) -> Query:
    return lambda spark, sf_dir: fn(warehouse_of(spark, sf_dir))


def _on_report(fn, *attributes: str) -> Query:
    return lambda spark, sf_dir: fn(reports.report_base(warehouse_of(spark, sf_dir), attributes))


# ── derived columns ──


def _derived(step, *needs) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = testdata.order_lines(spark, sf_dir)
        for need in needs:
            df = need(df)
        before = set(df.columns)
        after = step(df)
        return after.select(*LINE, *[c for c in after.columns if c not in before])

    return run


_DERIVED = {
    "drv_delivery_delay": _derived(derive.delivery_delay),
    "drv_on_time": _derived(derive.on_time, derive.delivery_delay),
    "drv_profit_margin": _derived(derive.profit_margin),
    "drv_cancelled": _derived(derive.cancelled),
    "drv_fulfilled": _derived(derive.fulfilled, derive.cancelled),
    "drv_revenue_at_risk": _derived(derive.revenue_at_risk, derive.cancelled, derive.fulfilled),
    "drv_cost_per_order": _derived(derive.cost_per_order),
    "drv_perfect_order": _derived(
        derive.perfect_order, derive.delivery_delay, derive.on_time, derive.cancelled, derive.fulfilled
    ),
    "drv_processing_days": _derived(derive.processing_days),
    "drv_order_week": _derived(derive.order_week),
}
for _name, _fn in _DERIVED.items():
    query(_name)(_fn)


@query("drv_summary")
def _(spark, sf_dir):
    return derive.derived_summary(derive.order_flags(testdata.order_lines(spark, sf_dir)))


@query("enrich_orders")
def _(spark, sf_dir):
    return derive.enrich_orders(testdata.order_lines(spark, sf_dir)).select(*ENRICHED_COLUMNS)


# ── star schema ──

query("dim_customers")(lambda spark, sf: star.dim_customers(clean.split_customers(_lines(spark, sf))))
query("dim_products")(lambda spark, sf: star.dim_products(clean.split_products(_lines(spark, sf))))
query("dim_suppliers")(lambda spark, sf: star.dim_suppliers(_lines(spark, sf)))
query("dim_date")(lambda spark, sf: star.dim_date(_lines(spark, sf)))
query("dim_geography")(lambda spark, sf: star.dim_geography(_lines(spark, sf)))


@query("fact_date_key")
def _(spark, sf_dir):
    dated = clean.rename_columns(clean.parse_dates(raw_of(spark, sf_dir)))
    return star.with_date_key(dated).select(*LINE, "date_id")


@query("fact_supplier_key")
def _(spark, sf_dir):
    suppliers = _dimension(spark, sf_dir, "dim_suppliers", star.dim_suppliers)
    return star.with_supplier_key(_lines(spark, sf_dir), suppliers).select(*LINE, "supplier_id")


@query("fact_geo_key")
def _(spark, sf_dir):
    geography = _dimension(spark, sf_dir, "dim_geography", star.dim_geography)
    return star.with_geo_key(_lines(spark, sf_dir), geography).select(*LINE, "geo_id")


@query("fact_orders")
def _(spark, sf_dir):
    suppliers = _dimension(spark, sf_dir, "dim_suppliers", star.dim_suppliers)
    geography = _dimension(spark, sf_dir, "dim_geography", star.dim_geography)
    return star.build_fact(_lines(spark, sf_dir), suppliers, geography)


@query("fact_coerce_types")
def _(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    text = {c: F.col(c).cast("string") for c in (*FLAG_COLUMNS, *AMOUNT_COLUMNS)}
    text["sales"] = F.when(F.col("order_id") % 97 == 0, "n/a").otherwise(text["sales"])
    text["profit"] = F.when(F.col("l_linenumber") != 7, text["profit"])
    text["on_time_flag"] = F.when(F.col("order_id") % 89 == 0, "x").otherwise(F.concat(text["on_time_flag"], F.lit(".0")))
    text["is_cancelled"] = F.when(F.col("l_linenumber") != 3, text["is_cancelled"])
    return star.coerce_fact_types(lines.withColumns(text)).select(*LINE, *FLAG_COLUMNS, *AMOUNT_COLUMNS)


query("star_join")(_on_warehouse(star.star_join))
query("supplier_products")(lambda spark, sf: star.supplier_products(_lines(spark, sf)))

# ── rollups ──

query("rollup_supplier")(lambda spark, sf: rollups.rollup_supplier(_lines(spark, sf)))
query("rollup_monthly")(lambda spark, sf: rollups.rollup_monthly(_lines(spark, sf)))
query("rollup_regional")(lambda spark, sf: rollups.rollup_regional(_lines(spark, sf)))
query("rollup_shipping")(lambda spark, sf: rollups.rollup_shipping(_lines(spark, sf)))
query("refresh_monthly")(_on_warehouse(rollups.refresh_monthly))
query("refresh_regional")(_on_warehouse(rollups.refresh_regional))

# ── KPIs and warehouse checks ──


def _kpi(name: str) -> Query:
    return lambda spark, sf_dir: kpis.kpi(warehouse_of(spark, sf_dir), name)


for _name in kpis.KPIS:
    query(_name)(_kpi(_name))
query("kpi_summary_vertical")(_on_warehouse(kpis.summary_vertical))

query("chk_totals")(_on_warehouse(checks.totals))
query("chk_delivery_status_share")(_on_warehouse(checks.delivery_status_share))
query("chk_revenue_by_market")(_on_warehouse(checks.revenue_by_market))
query("chk_top_categories")(_on_warehouse(checks.top_categories))
query("chk_segment_performance")(_on_warehouse(checks.segment_performance))
query("chk_yearly_summary")(_on_warehouse(checks.yearly_summary))
query("chk_supplier_summary")(_on_warehouse(checks.supplier_summary))

# ── report pages ──


@query("report_filter")
def _(spark, sf_dir):
    base = reports.report_base(warehouse_of(spark, sf_dir), **CHOICES)
    return base.select(*FACT_COLUMNS, *reports.FILTERS)


query("filter_options")(_on_warehouse(reports.filter_options))
query("exec_cards")(_on_report(reports.exec_cards))
query("exec_card_status")(_on_report(reports.exec_card_status))
query("monthly_revenue_profit")(_on_report(reports.monthly_revenue_profit, "month"))
query("revenue_by_market")(_on_report(reports.revenue_by_market))
query("delivery_status_counts")(_on_report(reports.delivery_status_counts))
query("supplier_table")(_on_report(reports.supplier_table, "department_name"))
query("supplier_best_worst")(_on_report(reports.supplier_best_worst, "department_name"))
query("fulfillment_cards")(_on_report(reports.fulfillment_cards))
query("units_by_category")(_on_report(reports.units_by_category))
query("fulfillment_by_category")(_on_report(reports.fulfillment_by_category))
query("monthly_fulfillment_trend")(_on_report(reports.monthly_fulfillment_trend, "month"))
query("order_status_distribution")(_on_report(reports.order_status_distribution))
query("cost_risk_cards")(_on_report(reports.cost_risk_cards))
query("margin_by_category")(_on_report(reports.margin_by_category))
query("risk_by_market")(_on_report(reports.risk_by_market))
query("cost_by_shipping")(_on_report(reports.cost_by_shipping))
query("monthly_margin_trend")(_on_report(reports.monthly_margin_trend, "month"))
query("daily_order_volume")(_on_report(reports.daily_order_volume))
query("orders_by_weekday")(_on_report(reports.orders_by_weekday))
query("revenue_by_quarter")(_on_report(reports.revenue_by_quarter, "quarter"))

# ── data quality ──


def _check(name: str) -> Query:
    return _on_warehouse(lambda star: quality.warehouse_health(star, [name]))


for _name in quality.CHECKS:
    query(f"dq_{_name}")(_check(_name))
query("dq_health_report")(_on_warehouse(quality.warehouse_health))
query("dq_scorecard")(_on_warehouse(quality.warehouse_scorecard))
query("dq_pk_unique")(_on_warehouse(quality.key_violations))
query("dq_fk_orphans")(_on_warehouse(quality.foreign_key_orphans))

# ── profiling ──

query("profile_columns")(lambda spark, sf: profile.profile_columns(raw_of(spark, sf)))
query("profile_domains")(lambda spark, sf: profile.profile_domains(raw_of(spark, sf)))
query("profile_business_stats")(lambda spark, sf: profile.business_stats(_cleaned(spark, sf)))
query("profile_distinct_values")(lambda spark, sf: profile.distinct_values(_cleaned(spark, sf)))
query("profile_nulls")(lambda spark, sf: profile.profile_nulls(raw_of(spark, sf)))
query("profile_dates")(lambda spark, sf: profile.profile_dates(_cleaned(spark, sf)))
query("domain_frames")(lambda spark, sf: profile.domain_frames(raw_of(spark, sf))["orders"])
query("domain_frames_customers")(lambda spark, sf: profile.domain_frames(raw_of(spark, sf))["customers"])
query("domain_frames_products")(lambda spark, sf: profile.domain_frames(raw_of(spark, sf))["products"])

# ── cleaning ──


@query("fill_numeric_median")
def _(spark, sf_dir):
    filled = clean.rename_columns(clean.fill_numeric_median(raw_of(spark, sf_dir)))
    # A count has the type of a possible midpoint only where it had nulls to fill.
    days = F.col("days_shipping_real").cast("double").alias("days_shipping_real")
    return filled.select(*LINE, F.col("quantity").cast("double").alias("quantity"), "sales", "discount_rate", "profit", days)


@query("fill_text_unknown")
def _(spark, sf_dir):
    filled = clean.rename_columns(clean.fill_text_unknown(raw_of(spark, sf_dir)))
    return filled.select(*LINE, "order_city", "order_status", "customer_city")


@query("parse_dates_lenient")
def _(spark, sf_dir):
    return clean.rename_columns(clean.parse_dates(raw_of(spark, sf_dir))).select(*LINE, *RAW_DATES.values())


@query("date_parts")
def _(spark, sf_dir):
    dated = clean.date_parts(clean.parse_dates(raw_of(spark, sf_dir)))
    parts = ["order_year", "order_month", "order_quarter", "order_dow"]
    return clean.rename_columns(dated).select(*LINE, *parts)


query("rename_columns")(lambda spark, sf: clean.rename_columns(raw_of(spark, sf)))


@query("standardize_text")
def _(spark, sf_dir):
    named = clean.rename_columns(raw_of(spark, sf_dir))
    return clean.standardize_text(named).select(*LINE, *TEXT_COLUMNS)


query("split_orders")(lambda spark, sf: clean.split_orders(_cleaned(spark, sf)))
query("split_customers")(lambda spark, sf: clean.split_customers(_cleaned(spark, sf)))
query("split_products")(lambda spark, sf: clean.split_products(_cleaned(spark, sf)))


def _split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    cleaned = _cleaned(spark, sf_dir)
    return clean.split_orders(cleaned), clean.split_customers(cleaned), clean.split_products(cleaned)


# ── sources and sinks ──


@query("scan_raw_csv")
def _(spark, sf_dir):
    path = fresh_path(spark, "raw-csv")
    writers.write_csv(raw_of(spark, sf_dir), path, options={"encoding": "ISO-8859-1", **writers.compressed_csv()})
    return clean.rename_columns(readers.read_raw_csv(spark, path))


def _clean_csvs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    folder = fresh_path(spark, "clean-csv")
    writers.save_cleaned(*_split(spark, sf_dir), folder, csv=True, options=writers.compressed_csv())
    return readers.read_clean_csvs(spark, folder)


query("scan_clean_csv")(lambda spark, sf: _clean_csvs(spark, sf)["orders"].select(*ORDER_COLUMNS))
query("scan_clean_csv_customers")(lambda spark, sf: _clean_csvs(spark, sf)["customers"])
query("scan_clean_csv_products")(lambda spark, sf: _clean_csvs(spark, sf)["products"])
query("parse_csv_timestamps")(lambda spark, sf: _clean_csvs(spark, sf)["orders"].select(*LINE, *RAW_DATES.values()))


@query("save_cleaned")
def _(spark, sf_dir):
    folder = fresh_path(spark, "clean")
    saved = writers.save_cleaned(*_split(spark, sf_dir), folder)
    return writers.readback(readers.read_tables(spark, folder, saved))


def _processed_folder(spark: SparkSession, sf_dir: str) -> str:
    folder = fresh_path(spark, "processed")
    writers.save_processed(warehouse.processed_tables(_lines(spark, sf_dir)), folder)
    return folder


@query("scan_processed")
def _(spark, sf_dir):
    return readers.read_processed(spark, _processed_folder(spark, sf_dir))["orders"].select(*ENRICHED_COLUMNS)


def _processed(name: str) -> Query:
    return lambda spark, sf_dir: readers.read_processed(spark, _processed_folder(spark, sf_dir))[name]


for _name in PROCESSED_TABLES[1:]:
    query(f"scan_processed_{_name}")(_processed(_name))


@query("save_processed")
def _(spark, sf_dir):
    folder = fresh_path(spark, "processed")
    counts = writers.save_processed(warehouse.processed_tables(_lines(spark, sf_dir)), folder)
    return spark.createDataFrame(list(counts.items()), "table_name string, n_rows bigint")


@query("readback_validation")
def _(spark, sf_dir):
    return writers.readback(readers.read_processed(spark, _processed_folder(spark, sf_dir)))


@query("sql_table_scan")
def _(spark, sf_dir):
    sql = """
        SELECT g.market, f.order_status, count(*) AS n_lines, sum(f.quantity) AS units
        FROM {fact_orders} f JOIN {dim_geography} g ON f.geo_id = g.geo_id
        GROUP BY g.market, f.order_status
    """
    return readers.query_tables(spark, warehouse_of(spark, sf_dir), sql)


@query("save_kpi")
def _(spark, sf_dir):
    folder, name = fresh_path(spark, "kpi"), "kpi05_inventory_by_category"
    result = kpis.kpi(warehouse_of(spark, sf_dir), name)
    writers.save_kpi(result, folder, name)
    return spark.read.option("header", True).schema(result.schema).csv(f"{folder}/{name}")


def _exported(status: DataFrame) -> DataFrame:
    return status.drop("error")


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    w = warehouse_of(spark, sf_dir)
    return {**{n: w[n] for n in WAREHOUSE_TABLES}, "fact_orders": w["fact_orders"].select(*FACT_COLUMNS)}


@query("bi_export_all")
def _(spark, sf_dir):
    """Status of every exported table, with what its files hold."""
    folder = fresh_path(spark, "export")
    status = _exported(writers.export_csv(spark, _tables(spark, sf_dir), folder))
    held = _read_back_csv(spark, folder, WAREHOUSE_TABLES)
    return status.select("table_name", "status").join(held, "table_name")



def _read_back_csv(spark: SparkSession, folder: str, names: Sequence[str]) -> DataFrame:
    """Rows, columns and empty fields of exported files, read as text."""
    read = spark.read.option("header", True).option("escape", '"').csv
    return writers.readback({n: read(f"{folder}/{n}") for n in names})


query("warehouse_load")(lambda spark, sf: snapshots.load_warehouse(spark, _tables(spark, sf), fresh_path(spark, "load")))


def _logged_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, n = fresh_path(spark, "runs"), _lines(spark, sf_dir).count()
    writers.log_run(spark, path, "SUCCESS", n, n, "fact_orders", 1.234)
    writers.log_run(spark, path, "FAILED", n, 0, "fact_orders", 0.5, "no input")
    writers.log_run(spark, path, "SUCCESS", n, n, "fact_orders", 2.0)
    return readers.run_history(spark, path).drop("run_timestamp")


query("run_log_append")(_logged_runs)

# ── batches ──


@query("shift_dates")
def _(spark, sf_dir):
    return _new_lines(spark, sf_dir).select(*LINE, "order_date", "ship_date")


@query("assign_next_keys")
def _(spark, sf_dir):
    lines = testdata.order_lines(spark, sf_dir).select("order_item_id", "order_id", "customer_id", "product_id", "sales")
    return batches.assign_next_keys(lines, lines)


@query("fact_append")
def _(spark, sf_dir):
    w, path = warehouse_of(spark, sf_dir), fresh_path(spark, "fact")
    writers.append_fact(w["fact_orders"], path, 0)
    new = derive.enrich_orders(_new_lines(spark, sf_dir))
    writers.append_fact(star.build_fact(new, w["dim_suppliers"], w["dim_geography"]), path, 1)
    fact = spark.read.parquet(path)
    return fact.groupBy("order_year").agg(
        F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("sales"), 2).cast("double").alias("revenue")
    )


def _after_append(spark: SparkSession, folder: str) -> DataFrame:
    """Lines and revenue of the fact by year, and of all four rollups by their keys."""
    w = warehouse.open_warehouse(spark, folder)
    years = w["fact_orders"].groupBy("order_year").agg(F.count(F.lit(1)).alias("total_orders"), F.sum("sales").cast("double").alias("total_revenue"))
    keys = {
        "fact_orders": (years, ["order_year"]),
        "kpi_monthly": (w["kpi_monthly"], rollups.MONTH_KEYS),
        "kpi_regional": (w["kpi_regional"], rollups.REGION_KEYS),
        "kpi_shipping": (w["kpi_shipping"], rollups.MODE_KEYS),
        "supplier_metrics": (w["supplier_metrics"], rollups.SUPPLIER_KEYS),
    }
    found = None
    for name, (rows, columns) in keys.items():
        part = rows.select(
            F.lit(name).alias("table_name"),
            F.concat_ws("/", *[F.col(c).cast("string") for c in columns]).alias("key"),
            F.col("total_orders").cast("bigint").alias("n_lines"),
            round_half_away(F.col("total_revenue"), 2).alias("revenue"),
        )
        found = part if found is None else found.unionByName(part)
    return found


def _daily(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """A warehouse after one daily batch, and its export folder."""
    folder, export, ranked = (fresh_path(spark, n) for n in ("daily", "export", "ranked-rows"))
    warehouse.build_warehouse(spark, testdata.order_lines(spark, sf_dir), folder)
    existing = warehouse.open_warehouse(spark, folder)["fact_orders"]
    new = batches.assign_next_keys(_new_lines(spark, sf_dir), existing, ranked)
    warehouse.run_daily(spark, folder, new, 1, export)
    drop_path(spark, ranked)
    return folder, export


query("daily_append_refresh")(lambda spark, sf: _after_append(spark, _daily(spark, sf)[0]))


@query("bi_export_refresh")
def _(spark, sf_dir):
    """What the daily run exports, read back: the new batch's fact rows and the refreshed figures."""
    return _read_back_csv(spark, _daily(spark, sf_dir)[1], REFRESHED_TABLES)


@query("run_history")
def _(spark, sf_dir):
    """Newest first, after a daily run and one that is refused for its types."""
    folder, _ = _daily(spark, sf_dir)
    bad = _new_lines(spark, sf_dir).withColumn("sales", F.lit("n/a"))
    try:
        warehouse.run_daily(spark, folder, bad, 2, None)
    except (AnalysisException, SparkRuntimeException, ValueError):
        pass  # it is in the log
    log = readers.run_history(spark, f"{folder}/{warehouse.RUN_LOG_TABLE}")
    return log.select("run_id", "status", "rows_processed", "rows_inserted", "source_table", F.col("error_message").isNotNull().cast("int").alias("failed"))


@query("stream_append_refresh")
def _(spark, sf_dir):
    """The daily cycle as an incremental job, run twice; the second run finds nothing new."""
    folder, incoming, checkpoint = (fresh_path(spark, n) for n in ("stream", "incoming", "stream-checkpoint"))
    lines = testdata.order_lines(spark, sf_dir)
    warehouse.build_warehouse(spark, lines, folder)
    _new_lines(spark, sf_dir).write.parquet(incoming)
    for _ in range(2):
        append_new_files(spark, incoming, lines.schema, folder, checkpoint).awaitTermination()
    return _after_append(spark, folder)
