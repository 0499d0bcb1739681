import random
import shutil
from functools import reduce

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from orderloom import testdata
from orderloom.functions.measures import distinct
from orderloom.operators import parts, quality
from orderloom.operators import star as operators_star
from orderloom.operators.clean import clean_lines, narrow_types
from orderloom.plans import batches, checks, kpis, reports, rollups, warehouse
from orderloom.schemas import FACT_COLUMNS, REFRESH_DROPS, TABLE_COLUMNS
from orderloom.sources import files, readers, snapshots, writers
from orderloom.streaming.append import LEDGER, append_new_files


@pytest.fixture(scope="module")
def lines(spark, sf):
    return testdata.order_lines(spark, sf)


def _rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def built(spark, lines, tmp_path_factory):
    """A warehouse over half of the lines, built once; tests change copies of it, as manifests name their parts by relative paths."""
    path = str(tmp_path_factory.mktemp("built") / "wh")
    warehouse.build_warehouse(spark, lines.where("order_id % 2 = 0"), path)
    return path


@pytest.fixture
def folder(built, tmp_path):
    return shutil.copytree(built, str(tmp_path / "wh"))


def test_rollups_from_the_cube_equal_direct_rollups(star):
    direct = rollups.rollups(star["lines"])
    for name, df in direct.items():
        assert _rows(star[name]) == _rows(df), name


def test_totals_agree_across_rollups(star):
    totals = {
        name: star[name].agg(F.sum("total_orders"), F.round(F.sum("total_revenue"), 2)).first()
        for name in ("kpi_monthly", "kpi_regional", "kpi_shipping", "supplier_metrics")
    }
    assert len(set(map(tuple, totals.values()))) == 1
    row = star["kpi_monthly"].agg(*[F.sum(c).alias(c) for c in ("perfect_orders", "fulfilled_orders", "cancelled_orders", "total_orders")]).first()
    assert row["perfect_orders"] <= row["fulfilled_orders"] <= row["total_orders"] - row["cancelled_orders"]


def test_fact_has_its_33_columns_and_all_lines(star, lines):
    fact = star["fact_orders"]
    assert [c for c in fact.columns if c not in ("batch_id", "order_year")] == list(FACT_COLUMNS)
    assert fact.count() == lines.count()


def test_written_tables_keep_their_contract(star):
    for name, columns in TABLE_COLUMNS.items():
        stored = [c for c in star[name].columns if name != "fact_orders" or c not in ("batch_id", "order_year")]
        assert sorted(stored) == sorted(columns), name


def test_append_in_two_batches_equals_one_load(spark, lines, folder, star):
    rest = lines.where("order_id % 2 = 1")
    read, added = warehouse.append_lines(spark, folder, rest, "daily-1")
    assert read == added == rest.count()
    after = warehouse.open_warehouse(spark, folder)
    for name in TABLE_COLUMNS:
        if name in ("kpi_monthly", "kpi_regional"):
            assert _rows(after[name]) == _rows(star[name]) and sorted(after[name].columns) == sorted(TABLE_COLUMNS[name])
    assert _rows(after["kpi_shipping"]) == _rows(star["kpi_shipping"])
    assert _rows(after["supplier_metrics"]) == _rows(star["supplier_metrics"])
    assert after["fact_orders"].count() == star["fact_orders"].count()
    for name in ("dim_date", "dim_customers", "dim_products"):
        assert _rows(after[name]) == _rows(star[name]), name
    # New places and suppliers continue the numbering; no fact row is left without a key.
    assert after["dim_geography"].count() == star["dim_geography"].count()
    ids = [r[0] for r in after["dim_geography"].select("geo_id").orderBy("geo_id").collect()]
    assert ids == list(range(1, len(ids) + 1))
    assert after["fact_orders"].where("geo_id IS NULL OR supplier_id IS NULL OR date_id IS NULL").count() == 0
    assert _rows(kpis.kpi(after, "kpi02_fulfillment_by_region")) == _rows(kpis.kpi(star, "kpi02_fulfillment_by_region"))


def test_replayed_batch_adds_nothing(spark, lines, folder):
    rest = lines.where("order_id % 2 = 1")
    warehouse.append_lines(spark, folder, rest, "daily-1")
    before = {n: _rows(df) for n, df in warehouse.open_warehouse(spark, folder).items() if n != "lines"}
    warehouse.append_lines(spark, folder, rest, "daily-1")
    after = {n: _rows(df) for n, df in warehouse.open_warehouse(spark, folder).items() if n != "lines"}
    assert after == before


def test_loading_again_starts_afresh(spark, lines, folder):
    before = {n: _rows(df) for n, df in warehouse.open_warehouse(spark, folder).items() if n != "lines"}
    warehouse.append_lines(spark, folder, batches.shift_dates(lines.where("order_id % 2 = 1")), "daily-1")
    warehouse.build_warehouse(spark, lines.where("order_id % 2 = 0"), folder)
    after = {n: _rows(df) for n, df in warehouse.open_warehouse(spark, folder).items() if n != "lines"}
    assert after == before


def test_first_load_cannot_be_overwritten_by_a_batch(spark, lines, folder):
    for bad in (0, "0", 3):
        with pytest.raises(ValueError):
            warehouse.append_lines(spark, folder, lines, bad)


def test_daily_run_logs_success_and_failure(spark, lines, folder, tmp_path):
    new = batches.shift_dates(lines.where("order_id % 50 = 1"))
    warehouse.run_daily(spark, folder, new, 1, str(tmp_path / "export"))
    broken = new.withColumn("sales", F.raise_error(F.lit("bad batch")).cast("decimal(12,2)"))
    with pytest.raises(Exception, match="bad batch"):
        warehouse.run_daily(spark, folder, broken, 2, str(tmp_path / "export"))
    runs = readers.run_history(spark, f"{folder}/pipeline_runs").collect()
    assert [(r["run_id"], r["status"]) for r in runs] == [(2, "FAILED"), (1, "SUCCESS")]
    assert runs[1]["rows_inserted"] == new.count() and "bad batch" in runs[0]["error_message"]
    exported = spark.read.option("header", True).csv(str(tmp_path / "export" / "kpi_monthly"))
    assert exported.columns[:2] == ["order_year", "order_month"]
    assert set(TABLE_COLUMNS["kpi_monthly"]) - set(exported.columns) == set(REFRESH_DROPS["kpi_monthly"])
    fact = spark.read.option("header", True).csv(str(tmp_path / "export" / "fact_orders"))
    assert fact.columns == list(FACT_COLUMNS) and fact.count() == new.count()


def test_daily_and_stream_batches_never_meet(spark, lines, folder, tmp_path):
    incoming = str(tmp_path / "in")
    start = warehouse.open_warehouse(spark, folder)["fact_orders"].count()
    day, files = batches.shift_dates(lines.where("order_id % 50 = 1")), lines.where("order_id % 50 = 3")
    warehouse.run_daily(spark, folder, day, 1, None)
    files.write.parquet(incoming)
    export = str(tmp_path / "export")
    append_new_files(spark, incoming, lines.schema, folder, str(tmp_path / "a"), export_folder=export).awaitTermination()
    assert warehouse.open_warehouse(spark, folder)["fact_orders"].count() == start + day.count() + files.count()
    append_new_files(spark, incoming, lines.schema, folder, str(tmp_path / "b")).awaitTermination()
    after = warehouse.open_warehouse(spark, folder)
    assert after["fact_orders"].count() == start + day.count() + files.count(), "another stream finds the same content"
    assert after["kpi_shipping"].agg(F.sum("total_orders")).first()[0] == after["fact_orders"].count()
    log = readers.run_history(spark, f"{folder}/pipeline_runs").collect()
    assert [r["status"] for r in log] == ["SUCCESS"] * 3
    assert spark.read.option("header", True).csv(f"{export}/fact_orders").count() == files.count()


def test_batch_of_other_types_is_cast_or_refused(spark, lines, folder):
    before = {n: _rows(df) for n, df in warehouse.open_warehouse(spark, folder).items() if n != "lines"}
    day = batches.shift_dates(lines.where("order_id % 50 = 1"))
    for bad in (F.lit("n/a"), F.lit("12345678901234.123456789").cast("decimal(25,9)")):
        with pytest.raises(ValueError, match="sales"):
            warehouse.append_lines(spark, folder, day.withColumn("sales", bad), "daily-1")
    after = {n: _rows(df) for n, df in warehouse.open_warehouse(spark, folder).items() if n != "lines"}
    assert after == before
    wide = day.withColumn("sales", F.col("sales").cast("decimal(25,9)"))
    assert warehouse.append_lines(spark, folder, wide, "daily-1")[1] == day.count()
    assert warehouse.open_warehouse(spark, folder)["fact_orders"].count() == lines.where("order_id % 2 = 0").count() + day.count()


def test_failed_refresh_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_table(spark.range(5), path)
    with pytest.raises(Exception, match="midway"):
        writers.replace_table(spark.range(5).select(F.raise_error(F.lit("midway")).alias("id")), path)
    assert spark.read.parquet(path).count() == 5
    assert writers.replace_table(spark.range(7), path) == 7 and spark.read.parquet(path).count() == 7


STEPS = ("lines", "dim_date", "fact_orders", "kpi_parts")


@pytest.fixture(scope="module")
def loaded(spark, built, tmp_path_factory):
    """A copy that several tests share, and what its readers see."""
    path = shutil.copytree(built, str(tmp_path_factory.mktemp("loaded") / "wh"))
    return path, _seen(spark, path)


def _seen(spark, folder):
    return {n: _rows(df) for n, df in warehouse.open_warehouse(spark, folder).items() if n in ("fact_orders", "kpi_monthly", "supplier_metrics", "dim_date", "report_base")}


@pytest.mark.parametrize("step", STEPS)
def test_a_stop_after_any_step_leaves_the_old_version(spark, lines, loaded, monkeypatch, step):
    folder, before = loaded
    staged = snapshots.Changes._stage

    def stopping(self, name, *args, **kwargs):
        staged(self, name, *args, **kwargs)
        if name == step:
            raise KeyboardInterrupt("stopped")

    with monkeypatch.context() as m:
        m.setattr(snapshots.Changes, "_stage", stopping)
        m.setattr(snapshots.Changes, "__exit__", lambda self, *error: None)  # a writer that dies cleans nothing up
        with pytest.raises(KeyboardInterrupt):
            warehouse.append_lines(spark, folder, batches.shift_dates(lines.where("order_id % 50 = 1")), "daily-1")
    assert _seen(spark, folder) == before
    assert snapshots.newest(spark, folder).number == 1


def test_leftovers_go_and_the_next_batch_is_whole(spark, lines, loaded):
    folder, before = loaded
    new = batches.shift_dates(lines.where("order_id % 50 = 1"))
    old = warehouse.open_warehouse(spark, folder)
    warehouse.append_lines(spark, folder, new, "daily-1")
    assert {n: _rows(old[n]) for n in before} == before, "readers of a version go on seeing it"
    after = warehouse.open_warehouse(spark, folder)
    assert after["fact_orders"].count() == after["lines"].count() == lines.where("order_id % 2 = 0").count() + new.count()
    assert snapshots.clean_up(spark, folder, keep=1)
    assert _seen(spark, folder) == {n: _rows(after[n]) for n in before}
    assert snapshots.clean_up(spark, folder, keep=1) == []


def test_second_writer_fails_and_changes_nothing(spark, lines, folder):
    day = batches.shift_dates(lines.where("order_id % 50 = 1"))
    with pytest.raises(snapshots.StaleWriter, match="version 2"):
        with snapshots.Changes(spark, folder) as slow:
            slow.put("kpi_monthly", spark.range(1))
            warehouse.append_lines(spark, folder, day, "daily-1")
            seen = _seen(spark, folder)
            slow.publish()
    assert _seen(spark, folder) == seen
    assert snapshots.newest(spark, folder).number == 2


@pytest.mark.parametrize("linked", [True, False])
def test_a_name_is_given_once(spark, tmp_path, monkeypatch, linked):
    if not linked:  # the way of file systems that are no local folder
        monkeypatch.setattr(files.os, "link", lambda a, b: files.rename_new(spark, a, b))
    path = str(tmp_path / "x" / "name")
    assert files.create_whole(spark, path, "first") and not files.create_whole(spark, path, "second")
    assert (tmp_path / "x" / "name").read_text() == "first"
    assert [p.name for p in (tmp_path / "x").iterdir() if not p.name.endswith(".crc")] == ["name"]


def test_unreadable_file_is_a_logged_failure(spark, sf, folder, tmp_path):
    raw = tmp_path / "bad.csv"
    raw.write_text("Order Id,Order Item Quantity\n1,3000000000\n")
    before = _seen(spark, folder)
    for n, path in ((1, str(raw)), (2, str(tmp_path / "none.csv"))):
        with pytest.raises(Exception):
            warehouse.run_daily_file(spark, folder, path, n, None)
    assert _seen(spark, folder) == before
    runs = readers.run_history(spark, f"{folder}/pipeline_runs").collect()
    assert [(r["run_id"], r["status"], r["rows_inserted"]) for r in runs] == [(2, "FAILED", 0), (1, "FAILED", 0)]
    assert "does not fit" in runs[1]["error_message"]


def test_same_content_under_another_name_is_added_once(spark, lines, folder, tmp_path):
    incoming, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    start = warehouse.open_warehouse(spark, folder)["fact_orders"].count()
    part = lines.where("order_id % 50 = 3").withColumn("order_city", F.when(F.col("order_id") % 4 > 0, F.col("order_city")))
    part.coalesce(1).write.parquet(incoming)
    part.orderBy(F.desc("order_item_id")).coalesce(1).write.mode("append").parquet(incoming)  # twice in one batch
    append_new_files(spark, incoming, lines.schema, folder, checkpoint).awaitTermination()
    part.coalesce(1).write.mode("append").option("compression", "gzip").parquet(incoming)
    lines.where("order_id % 50 = 5").coalesce(1).write.mode("append").parquet(incoming)
    append_new_files(spark, incoming, lines.schema, folder, checkpoint).awaitTermination()
    part.coalesce(1).write.mode("append").parquet(incoming)  # a batch of nothing else
    append_new_files(spark, incoming, lines.schema, folder, checkpoint).awaitTermination()
    after = warehouse.open_warehouse(spark, folder)
    assert after["fact_orders"].count() == start + part.count() + lines.where("order_id % 50 = 5").count()
    ledger = snapshots.open_tables(spark, folder, snapshots.newest(spark, folder), [LEDGER])[LEDGER]
    assert sorted(r["status"] for r in ledger.collect()) == ["added"] * 2 + ["repeated"] * 3
    log = readers.run_history(spark, f"{folder}/pipeline_runs").collect()
    assert [(r["status"], r["rows_inserted"]) for r in log[:1]] == [("SUCCESS", 0)]


def test_figures_come_from_stored_parts(spark, lines, folder):
    """After a batch, with orders that were there already, KPIs and checks equal those from the fact without reading it."""
    again = batches.shift_dates(lines.where("order_id % 50 IN (1, 2)"))
    warehouse.append_lines(spark, folder, again, "daily-1")
    after = warehouse.open_warehouse(spark, folder)
    direct = parts.without_parts(after)
    found = {f"kpi {n}": (kpis.kpi(after, n), kpis.kpi(direct, n)) for n in kpis.KPIS}
    for check in (checks.totals, checks.delivery_status_share, checks.revenue_by_market, checks.top_categories, checks.segment_performance, checks.yearly_summary):
        found[check.__name__] = (check(after), check(direct))
    for name, (merged, counted) in found.items():
        plan = merged._jdf.queryExecution().optimizedPlan().toString()
        assert merged.collect() == counted.collect(), name
        assert "fact_orders" not in merged._jdf.queryExecution().executedPlan().toString() and "order_item_id" not in plan, name
    base = reports.report_base(after, ["department_name"])
    twice = {**direct, "fact_orders": after["fact_orders"]}
    for merged, counted in (
        (quality.warehouse_health(after), quality.health_report(base)),
        (quality.warehouse_scorecard(after), quality.scorecard(base)),
        (quality.foreign_key_orphans(parts.Warehouse({**after, "dim_products": after["dim_products"].where("product_id % 2 = 0")})),
         quality.foreign_key_orphans({**twice, "dim_products": after["dim_products"].where("product_id % 2 = 0")})),
    ):
        assert _rows(merged) == _rows(counted) and any(r for r in merged.collect())
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "fact_orders" not in plan and "report_base" not in plan
    assert {r["check"]: r["value"] for r in quality.warehouse_health(after).collect()}["duplicate_items"] > 0


def test_sets_of_few_and_many_ids_merge(spark, monkeypatch):
    monkeypatch.setattr(parts, "FEW_PLACES", 20)
    grouping = {"fact_g": parts.Grouping(None, ("g",), (distinct("order_id", "n"),))}
    halves = [
        spark.range(a, b, step).select((F.col("id") % 3).alias("g"), (F.col("id") - 100).alias("order_id"))
        for a, b, step in ((0, 300, 1), (200, 420, 7), (0, 400000, 1777))
    ]
    extra = spark.createDataFrame([(None, -5), (None, None), (None, -5), (1, -(2**63)), (1, 2**63 - 1)], "g bigint, order_id bigint")
    batches_ = [*halves, extra]
    stored = reduce(lambda a, b: a.unionByName(b), [parts.batch_distincts({"fact_orders": b}, grouping) for b in batches_])
    assert stored.where("bits IS NOT NULL").count() and stored.where("places IS NOT NULL").count()
    found = {r["key"]: r["n"] for r in parts._counted(stored).collect()}
    rows = reduce(lambda a, b: a.union(b), batches_).groupBy("g").agg(F.count_distinct("order_id").alias("n")).collect()
    assert found == {"{}" if r["g"] is None else f'{{"g":{r["g"]}}}': r["n"] for r in rows}


def test_contract_names_what_is_wrong(spark):
    with pytest.raises(ValueError, match="geo_id is string.*order_city is missing"):
        writers.check_contract(spark.createDataFrame([("a", "b", "c", "d", "e")], "geo_id string, market string, order_region string, order_country string, order_state string"), "dim_geography")


def test_report_pages_read_the_stored_base(star):
    for page in (reports.exec_cards, reports.units_by_category, reports.delivery_status_counts):
        plan = page(reports.report_base(star))._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan
    joined = {n: df for n, df in star.items() if n != reports.REPORT_BASE}
    assert _rows(reports.report_base(star, ["month"])) == _rows(reports.report_base(joined, ["month"]))


def test_base_of_one_market_lies_in_few_files(spark, lines, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions stay apart, as large ones do
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        star = warehouse.build_warehouse(spark, lines, str(tmp_path / "wh"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    found = []
    for file in (tmp_path / "wh" / "report_base").rglob("*.parquet"):
        table = pq.read_table(file, columns=["market", "category"], partitioning=None).to_pydict()
        rows = list(zip(table["market"], table["category"]))
        assert rows == sorted(rows), "row groups cover short ranges"
        found.append((min(table["market"]), max(table["market"])))
    asked = [low <= "ASIA" <= high for low, high in found]
    assert 0 < sum(asked) < len(asked) / 2, "minima and maxima leave most files out"
    base = reports.report_base(star, markets=["ASIA"])
    assert "EqualTo(market,ASIA)" in base._jdf.queryExecution().executedPlan().toString()
    assert base.count() == star["report_base"].where("market = 'ASIA'").count() > 0


def test_stream_takes_each_file_once(spark, lines, folder, tmp_path, star):
    incoming, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")

    def run():
        append_new_files(spark, incoming, lines.schema, folder, checkpoint, files_per_batch=1).awaitTermination()
        return warehouse.open_warehouse(spark, folder)["fact_orders"].count()

    half = lines.where("order_id % 2 = 0").count()
    first, second = lines.where("order_id % 4 = 1"), lines.where("order_id % 4 = 3")
    first.coalesce(1).write.parquet(incoming)
    assert run() == half + first.count()
    assert run() == half + first.count()
    second.coalesce(1).write.mode("append").parquet(incoming)
    assert run() == lines.count()
    after = warehouse.open_warehouse(spark, folder)
    assert _rows(after["kpi_monthly"]) == _rows(star["kpi_monthly"])
    assert _rows(after["supplier_metrics"]) == _rows(star["supplier_metrics"])


def test_raw_csv_to_warehouse_to_kpi_files(spark, sf, tmp_path):
    raw = str(tmp_path / "raw")
    writers.write_csv(testdata.raw_lines(spark, sf), raw, options={"encoding": "ISO-8859-1"})
    star = warehouse.run_etl(spark, raw, str(tmp_path / "wh"))
    direct = narrow_types(clean_lines(testdata.raw_lines(spark, sf)))
    assert star["fact_orders"].count() == direct.count()
    assert star["fact_orders"].agg(F.sum("is_cancelled")).first() == direct.agg(F.sum("is_cancelled")).first()
    counts = warehouse.run_kpis(spark, star, str(tmp_path / "kpis"))
    assert len(counts) == 27 and counts["kpi_executive_summary"] == 1
    saved = spark.read.option("header", True).csv(str(tmp_path / "kpis" / "kpi01_on_time_by_mode"))
    assert saved.count() == 4
    # A daily file: fields that are no number are counted with the batch, and nothing is left behind.
    day, folder = str(tmp_path / "day"), str(tmp_path / "wh")
    oops = F.when(F.col("Order Id") % 100 == 1, F.lit("oops")).otherwise(F.col("Sales").cast("string"))
    given = testdata.raw_lines(spark, sf).where("`Order Id` % 50 = 1").withColumn("Sales", oops)
    writers.write_csv(given, day, options={"encoding": "ISO-8859-1"})
    warehouse.run_daily_file(spark, folder, day, 1, None)
    found = snapshots.open_tables(spark, folder, snapshots.newest(spark, folder), [warehouse.UNREADABLE])[warehouse.UNREADABLE]
    bad = {r["column"]: r["n_unreadable"] for r in found.where("batch_id = 'daily-1'").collect()}
    assert bad["Sales"] == given.where("Sales = 'oops'").count() > 0 and bad["Order Id"] == 0
    last = readers.run_history(spark, f"{folder}/pipeline_runs").first()
    assert (last["status"], last["rows_inserted"]) == ("SUCCESS", given.count())


def test_next_keys_follow_the_largest(spark):
    existing = spark.createDataFrame([(10,), (70000,)], "order_item_id bigint")
    batch = spark.range(9000).select((F.col("id") % 3000).alias("order_item_id"), F.col("id").alias("v"))
    without_ids = batch.withColumn("order_item_id", F.lit(None).cast("bigint"))
    assert without_ids.select(batches.row_bucket(without_ids)).distinct().count() > 3000
    ids = sorted(r[0] for r in batches.assign_next_keys(without_ids, existing).select("order_item_id").collect())
    assert ids == list(range(70001, 79001))
    found = sorted(r[0] for r in batches.assign_next_keys(batch, existing).select("order_item_id").collect())
    assert found == list(range(70001, 79001))
    assert batches.assign_next_keys(batch.limit(1), existing.where("false")).first()["order_item_id"] == 1


def test_numbering_reads_its_input_once(spark):
    """Another random column at every evaluation: numbered from two of them, numbers would repeat or be left out."""
    reads = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def other(x):
        reads.add(1)
        return random.random()

    batch = spark.range(700, numPartitions=3).select(F.col("id").alias("order_item_id"), other.asNondeterministic()("id").alias("v"))
    numbered = batches.assign_next_keys(batch, spark.createDataFrame([(10,)], "order_item_id bigint"))
    for _ in range(2):
        assert sorted(r[0] for r in numbered.collect()) == list(range(11, 711))
    assert reads.value == 700


def test_sample_has_its_size_and_repeats_rows(spark):
    df = spark.range(100)
    drawn = [r[0] for r in batches.bootstrap_sample(df, 80, seed=3).collect()]
    assert len(drawn) == 80 and len(set(drawn)) < 80 and set(drawn) <= set(range(100))
    assert batches.bootstrap_sample(df, 250, seed=3).count() == 250
    assert batches.bootstrap_sample(df.limit(0), 5, seed=3).count() == 0


def test_a_caller_can_drop_the_ranked_rows_of_a_batch(spark, sf, tmp_path):
    from orderloom import testdata
    from orderloom.plans import batches

    lines = testdata.order_lines(spark, sf).limit(50)
    ranked = tmp_path / "ranked"
    numbered = batches.assign_next_keys(lines, lines, str(ranked))
    assert ranked.exists() and numbered.count() == 50


def test_cube_has_a_row_for_each_group_of_a_rollup(star):
    """Not one for each combination of month, region, mode and supplier that occurs, which is nearly one per line."""
    wide = star["lines"]
    cube = rollups.rollup_cube(wide)
    keys = [rollups.MONTH_KEYS, rollups.REGION_KEYS, rollups.MODE_KEYS, [*rollups.SUPPLIER_KEYS, "order_region"]]
    assert cube.count() == sum(wide.select(*k).distinct().count() for k in keys)
    fresh = rollups.rollups_from_cube(cube.unionByName(cube), rollups.supplier_product_pairs(wide))
    direct = rollups.rollups(wide.unionByName(wide))
    for name, rows in direct.items():
        assert _rows(fresh[name].select(*rows.columns)) == _rows(rows), name


def test_figures_of_lines_that_bear_their_attributes_are_those_through_the_dimension(spark, star):
    """Also where lines contradict their dimension row, or refer to none."""
    lines = star["lines"].withColumns({
        "category": F.when(F.col("order_id") % 7 != 0, F.col("category")),
        "segment": F.when(F.col("order_id") % 5 == 0, "OTHER").otherwise(F.col("segment")),
        "product_id": F.when(F.col("order_id") % 11 != 0, F.col("product_id")),
    })
    through = {**parts.without_parts(star), "fact_orders": operators_star.build_fact(lines, star["dim_suppliers"], star["dim_geography"])}
    bearing = {
        d: operators_star.bearing_rows(lines, d, operators_star.line_corrections(lines, star[d], d), through["fact_orders"])
        for d in operators_star.LARGE_DIMENSIONS
    }
    given = {n: g for n, g in warehouse.KPI_GROUPINGS.items() if g.through in bearing}
    assert _rows(parts.batch_parts(through, given, bearing)) == _rows(parts.batch_parts(through, given))
    sets = [parts.batch_distincts(through, given, b).withColumn("places", F.array_sort("places")) for b in (bearing, {})]
    assert _rows(sets[0]) == _rows(sets[1])


def test_ids_are_collected_in_a_task_before_they_are_shuffled(spark):
    ids = spark.range(5000).select((F.col("id") % 3000 + 1).alias("order_id"), F.lit("a").alias("order_status"))
    grouping = {"g": parts.Grouping(None, ("order_status",), (distinct("order_id", "n"),))}
    sets = parts.batch_distincts({"fact_orders": ids}, grouping)
    rows = sets.collect()
    assert [(r["places"], r["bits"] is not None) for r in rows] == [(None, True)]
    assert parts._counted(sets).first()["n"] == 3000
    plan = sets._jdf.queryExecution().executedPlan().toString()
    assert "partial_collect_set" in plan and "REPARTITION_BY_COL" not in plan
