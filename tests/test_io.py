import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderloom import testdata
from orderloom.operators import profile
from orderloom.plans import warehouse
from orderloom.sources import readers, writers


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.read_raw_csv(spark, str(tmp_path / "none.csv"))


def test_all_missing_tables_are_named(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "orders"))
    with pytest.raises(FileNotFoundError, match="customers, products"):
        readers.read_tables(spark, str(tmp_path), ["orders", "customers", "products"])


def test_raw_csv_by_name_latin1_and_missing_markers(spark, tmp_path):
    path = tmp_path / "raw.csv"
    text = (
        "Sales ,Extra,Order Id,Order City,Customer Zipcode,Order Item Quantity\n"
        '12.34567891,"a ""quoted"", text",7,M\xe9xico,00725,NA\n'
        "oops,,8,,NULL,3\n"
    )
    path.write_bytes(text.encode("latin-1"))
    df = readers.read_raw_csv(spark, str(path))
    assert df.columns == ["Sales", "Extra", "Order Id", "Order City", "Customer Zipcode", "Order Item Quantity"]
    first, second = df.collect()
    assert first["Sales"] == Decimal("12.34567891") and first["Order Id"] == 7
    assert first["Order City"] == "M\xe9xico" and first["Customer Zipcode"] == "00725"
    assert first["Extra"] == 'a "quoted", text' and first["Order Item Quantity"] is None
    assert (second["Sales"], second["Order City"], second["Customer Zipcode"]) == (None, None, None)


def test_multiline_fields_on_request(spark, tmp_path):
    (tmp_path / "m.csv").write_text('Order Id,Product Name\n1,"two\nlines"\n')
    assert readers.read_raw_csv(spark, str(tmp_path / "m.csv"), multiline=True).first()["Product Name"] == "two\nlines"


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in before:
        spark.conf.set(k, "200")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_line_breaks_in_fields_are_read_in_many_tasks(spark, tmp_path, small_splits):
    """Records of many lines, longer than a split, doubled quotes, files of either line end: the rows of the one-task reader."""
    rng = random.Random(1)
    for file, end in (("a.csv", "\r\n"), ("b.csv", "\n")):
        pieces = ["a", end, '""', ",", "é", " ", end * 2, '"",""', "x" * 40]
        out = ["Order Id,Product Name,Sales" + end]
        for i in range(150):
            field = "".join(rng.choice(pieces) for _ in range(rng.choice([0, 1, 3, 9])))
            out.append(f'{i},"{field}",{rng.choice(["", "1.5", "plain"])}{end}')
            if i == 70:
                out.append('999,"' + f"long {end}" * 200 + f'",2{end}{end}')
        (tmp_path / file).write_bytes("".join(out).encode("latin-1"))
    found = readers.read_raw_text(spark, str(tmp_path), multiline=True)
    one = spark.read.option("header", True).option("encoding", "ISO-8859-1").option("escape", '"').option("multiLine", True).csv(str(tmp_path))
    assert found.columns == one.columns
    assert sorted(map(repr, found.collect())) == sorted(map(repr, one.collect()))
    lines = spark.read.option("lineSep", "\n").text(str(tmp_path))
    assert lines.rdd.getNumPartitions() > 20


def test_wrong_header_of_a_clean_file_fails(spark, tmp_path):
    for name in ("orders", "customers", "products"):
        os.makedirs(tmp_path / f"{name}_clean")
        (tmp_path / f"{name}_clean" / "part.csv").write_text("a,b\n1,2\n")
    with pytest.raises(Exception):
        readers.read_clean_csvs(spark, str(tmp_path))["orders"].collect()


def test_failing_table_is_reported_and_skipped(spark, tmp_path):
    good = spark.range(3)
    bad = spark.range(1).selectExpr("cast(raise_error('broken') AS string) AS x")
    status = {r["table_name"]: r for r in writers.export_csv(spark, {"a": good, "b": bad}, str(tmp_path), ["a", "b", "c"]).collect()}
    assert (status["a"]["status"], status["a"]["n_rows"], status["a"]["n_columns"]) == ("ok", 3, 1)
    assert status["b"]["status"] == "failed" and "broken" in status["b"]["error"]
    assert status["c"]["status"] == "failed" and "KeyError" in status["c"]["error"]


def test_kpi_result_is_one_csv_file(spark, tmp_path):
    assert writers.save_kpi(spark.range(20).repartition(4).orderBy("id"), str(tmp_path), "k") == 20
    files = [f for f in os.listdir(tmp_path / "k") if f.endswith(".csv")]
    assert len(files) == 1
    assert (tmp_path / "k" / files[0]).read_text().splitlines()[:3] == ["id", "0", "1"]


def test_run_log_counts_up_and_lists_newest_first(spark, tmp_path):
    path = str(tmp_path / "log")
    writers.log_run(spark, path, "SUCCESS", 5, 5, "fact_orders", 1.239)
    writers.log_run(spark, path, "FAILED", 5, 0, "fact_orders", 0.1, "boom")
    rows = readers.run_history(spark, path).collect()
    assert [(r["run_id"], r["status"], r["duration_secs"], r["error_message"]) for r in rows] == [
        (2, "FAILED", 0.1, "boom"), (1, "SUCCESS", 1.24, None)]


def test_readback_counts_nulls(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert tuple(writers.readback({"t": df}).first()) == ("t", 3, 2, 3)


def test_sql_over_tables(spark, star):
    sql = "SELECT count(*) AS n FROM {fact_orders}"
    assert readers.query_tables(spark, star, sql).first()["n"] == star["fact_orders"].count()
    readers.register_views({"some_fact": star["fact_orders"]})
    assert spark.sql("SELECT count(*) AS n FROM some_fact").first()["n"] == star["fact_orders"].count()


def test_profile_of_doubles_and_empty_columns(spark):
    df = spark.createDataFrame([(0.0, None), (-0.0, None), (None, None)], "x double, `odd name (y)` string")
    found = {r["column"]: r for r in profile.profile_columns(df).collect()}
    assert (found["x"]["nulls"], found["x"]["unique_values"], found["x"]["null_pct"]) == (1, 1, 33.33)
    assert found["odd name (y)"]["sample"] == "N/A" and found["odd name (y)"]["unique_values"] == 0


def test_profile_sketch_agrees_on_few_values(spark, star):
    lines = star["lines"].select("market", "shipping_mode", "order_id")
    exact = {r["column"]: r for r in profile.profile_columns(lines).collect()}
    rough = {r["column"]: r for r in profile.profile_columns(lines, approximate=True).collect()}
    for c in ("market", "shipping_mode"):
        assert exact[c] == rough[c]
    assert abs(rough["order_id"]["unique_values"] / exact["order_id"]["unique_values"] - 1) < 0.15


def test_profile_repeats_no_row_and_merges_batches(spark, sf, tmp_path):
    raw = testdata.raw_lines(spark, sf).drop("Order Item Id")
    path = str(tmp_path / "raw")
    writers.write_table(raw.select(*raw.columns, F.array("`Order Id`").alias("list"), F.when(F.col("Order Id") % 2 == 0, F.lit(-0.0)).otherwise(F.lit(0.0)).alias("zero")), path)
    raw = spark.read.parquet(path)
    whole = profile.profile_columns(raw)
    assert "Expand" not in whole._jdf.queryExecution().optimizedPlan().toString()
    folder = str(tmp_path / "wh")
    for batch in range(3):
        warehouse.store_profile(spark, folder, raw.where(f"`Order Id` % 3 = {batch}"), f"daily-{batch}")
    warehouse.store_profile(spark, folder, raw.where("`Order Id` % 3 = 1"), "daily-1")  # again
    stored = warehouse.stored_profile(spark, folder)
    assert path not in stored._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, whole.collect()))
    expected = raw.agg(F.count_distinct("Order City"), F.count_if(F.col("Order City").isNull()), F.min("Order City")).first()
    city = whole.where("column = 'Order City'").first()
    assert (city["unique_values"], city["nulls"], city["sample"]) == tuple(expected)
    assert whole.where("column = 'zero'").first()["unique_values"] == 1


def test_numbers_of_raw_files_arrive_whole(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        "Order Id,Sales,Order Item Quantity,Days for shipping (real)\n"
        "200000000000000001,12345678901.50,3.0,2\n"
        "7,0.039999999,x,2.5\n"
        "NA,1e3,,-1\n"
    )
    rows = readers.read_raw_csv(spark, str(path)).collect()
    assert [r["Order Id"] for r in rows] == [200000000000000001, 7, None]
    assert [str(r["Sales"]) for r in rows] == ["12345678901.500000000", "0.039999999", "1000.000000000"]
    assert [r["Order Item Quantity"] for r in rows] == [3, None, None]
    assert [r["Days for shipping (real)"] for r in rows] == [2, None, -1]
    bad = {r["column"]: r["n_unreadable"] for r in readers.unreadable_numbers(readers.read_raw_text(spark, str(path))).collect()}
    assert bad == {"Order Id": 0, "Sales": 0, "Order Item Quantity": 1, "Days for shipping (real)": 1}


def test_number_too_large_for_its_column_is_an_error(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("Order Item Quantity,Sales\n3000000000,1\n")
    with pytest.raises(Exception, match="quantity|Quantity.*does not fit"):
        readers.read_raw_csv(spark, str(path)).collect()
