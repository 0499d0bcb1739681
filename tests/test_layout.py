"""How the tables of a warehouse lie on disk."""

import json

from pyspark.sql import functions as F

from orderloom.schemas import FACT_COLUMNS
from orderloom.sources import snapshots


def test_fact_and_report_base_are_one_table(star):
    files = star["fact_orders"].inputFiles()
    assert files and sorted(files) == sorted(star["report_base"].inputFiles())
    assert star["fact_orders"].columns == [*FACT_COLUMNS, "batch_id", "order_year"]
    assert star["fact_orders"].count() == star["lines"].count()


def test_lines_lie_in_no_year_folders(star):
    assert not [f for f in star["lines"].inputFiles() if "order_year=" in f]
    years = star["lines"].where(F.col("order_year") != F.year("order_date")).count()
    assert years == 0


def test_parts_with_other_folders_are_read_together(spark, tmp_path):
    folder = str(tmp_path / "wh")
    rows = spark.createDataFrame([(1, 1996, "ASIA"), (2, 1997, None)], "id bigint, order_year int, market string")
    with snapshots.Changes(spark, folder) as new:
        new.put_batch("base", rows, "a")
        new.put_batch("base", rows, "b", ["order_year"], ["market"])
        new.put_batch("ids", rows.select("id", "order_year"), "a")
        new.share_batch("ids", "base", "b", ["id"])
        new.publish()
    held = snapshots.open_tables(spark, folder, snapshots.newest(spark, folder))
    found = sorted(tuple(r) for r in held["base"].select("id", "order_year", "market", "batch_id").fillna("-").collect())
    assert found == [(i, y, m, b) for i, y, m in ((1, 1996, "ASIA"), (2, 1997, "-")) for b in "ab"]
    assert sorted(tuple(r) for r in held["ids"].select("id", "batch_id").collect()) == [(1, "a"), (1, "b"), (2, "a"), (2, "b")]
    with snapshots.Changes(spark, folder) as new:  # a part that is shared stays while a table names it
        new.put_batch("base", rows, "b", ["order_year"])
        new.publish()
    snapshots.clean_up(spark, folder, keep=1)
    assert snapshots.open_tables(spark, folder, snapshots.newest(spark, folder))["ids"].count() == 4


def test_manifests_without_folders_are_read(spark):
    schema = spark.range(1).schema.jsonValue()
    text = json.dumps({"version": 3, "tables": {"t": {"schema": schema, "parts": [{"path": "t/part=x", "batch": "0", "rows": 5}]}}})
    assert snapshots.Version.of_text(text).tables["t"].parts == (snapshots.Part("t/part=x", "0", 5),)


def test_numbered_rows_are_not_shuffled_to_meet_their_buckets(spark, tmp_path):
    from orderloom.plans.batches import assign_next_keys

    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = spark.range(500).select(F.col("id").alias("order_item_id"), (F.col("id") % 7).alias("n"))
        keyed = assign_next_keys(batch, batch, str(tmp_path / "ranked"))
        ids = sorted(r["order_item_id"] for r in keyed.collect())
        plan = keyed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert ids == list(range(500, 1000))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_csv_that_is_read_back_is_compressed_in_short_files(spark, sf, tmp_path, monkeypatch):
    from orderloom import catalog
    from orderloom.sources import writers

    monkeypatch.setattr(writers, "ROWS_OF_A_CSV_FILE", 30)
    monkeypatch.setattr(catalog, "fresh_path", lambda spark, name: str(tmp_path / name))
    rows = spark.range(200).select(F.col("id").alias("Order Id"), F.lit(' é "x", ').alias("Product Name")).coalesce(1)
    monkeypatch.setattr(catalog, "raw_of", lambda spark, sf_dir: rows)
    found = catalog.QUERIES["scan_raw_csv"](spark, sf)
    files = [f for f in (tmp_path / "raw-csv").rglob("part-*") if f.suffix != ".crc"]
    assert len(files) == 7 and all(f.name.endswith(".csv.gz") for f in files)
    assert sorted(r["order_id"] for r in found.collect()) == list(range(200))
    assert found.select("product_name").distinct().first()[0] == ' é "x", '
    cleaned = spark.range(3).select(F.col("id").alias("order_id"))
    writers.save_cleaned(cleaned, cleaned, cleaned, str(tmp_path / "c"), csv=True, options=writers.compressed_csv())
    assert all(list((tmp_path / "c" / f"{n}_clean").glob("*.csv.gz")) for n in ("orders", "customers", "products"))
