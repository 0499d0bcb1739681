import datetime as dt

import pytest

from orderloom.functions.text import standard_text, strip_blanks, title_case
from orderloom.operators import clean
from pyspark.sql import functions as F


def _apply(spark, fn, *values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r[0] for r in df.select(fn(F.col("s"))).collect()]


@pytest.mark.parametrize("text", ["women's apparel", "PENDING_PAYMENT", "south of  usa", "3rd party", "élan vital", "", "a1b2"])
def test_title_case_is_the_one_of_python(spark, text):
    assert _apply(spark, title_case, text) == [text.title()]


def test_strip_removes_all_kinds_of_blanks(spark):
    assert _apply(spark, strip_blanks, " \t a b  \n", "x") == ["a b", "x"]


def test_standard_text_keeps_null(spark):
    assert _apply(spark, standard_text, None, "  CANCELED\t") == [None, "Canceled"]


def test_missing_date_text_ends_as_null_date(spark):
    df = spark.createDataFrame(
        [(1, "1/31/2015 9:05", "2/1/2015 0:00"), (2, None, "bad"), (3, "13/45/2015 1:00", "2/3/2015 23:59")],
        "`Order Id` int, `order date (DateOrders)` string, `shipping date (DateOrders)` string",
    )
    rows = clean.rename_columns(clean.date_parts(clean.parse_dates(clean.fill_text_unknown(df)))).orderBy("order_id").collect()
    assert rows[0]["order_date"] == dt.datetime(2015, 1, 31, 9, 5)
    assert (rows[0]["order_dow"], rows[0]["order_quarter"]) == ("Saturday", 1)
    assert [r["order_date"] for r in rows[1:]] == [None, None]
    assert rows[1]["ship_date"] is None and rows[1]["order_year"] is None


def test_other_date_formats(spark):
    df = spark.createDataFrame([("2015-02-01",), ("2/1/2015 0:00",)], "`order date (DateOrders)` string")
    rows = clean.parse_dates(df, ["M/d/yyyy H:mm", "yyyy-MM-dd"]).collect()
    assert {r["order_date"] for r in rows} == {dt.datetime(2015, 2, 1)}


def test_rename_takes_what_is_there_and_ignores_header_blanks(spark):
    df = spark.createDataFrame([(1, "x", 2)], "`Order Id ` int, Other string, `  Sales` int")
    assert clean.rename_columns(df).columns == ["order_id", "Other", "sales"]


def test_keep_first_is_by_item_then_payload_and_survives_a_hot_key(spark):
    rows = [(1, 5, "late"), (1, 2, "b"), (1, 2, "a"), (2, 9, None), (2, 9, "z"), (3, None, "n")]
    hot = [(1, 100 + i, f"p{i}") for i in range(2000)]
    df = spark.createDataFrame(rows + hot, "customer_id int, order_item_id int, first_name string").repartition(6)
    found = {r["customer_id"]: r["first_name"] for r in clean.split_customers(df).collect()}
    assert found == {1: "a", 2: None, 3: "n"}


def test_splits_take_the_columns_that_exist(spark):
    df = spark.createDataFrame([(1, 2, "A", 3)], "order_id int, customer_id int, market string, order_item_id int")
    assert clean.split_orders(df).columns == ["order_id", "order_item_id", "customer_id", "market"]
    assert clean.split_customers(df).columns == ["customer_id"]


def test_title_case_replaces_only_where_something_follows_a_non_letter(spark):
    from orderloom.functions.text import title_case

    values = ["same DAY", "women's  gOODS", "brand#13b", "a_b-C", " ÉTÉ x", "-ⅰ", "ΑΣ1Σ", "ΑΣ", "", None, "x\ty", "a  b."]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    spaced = F.regexp_replace("v", r"(\P{L})", "$1 ")
    always = F.regexp_replace(F.initcap(spaced), r"(\P{L}) ", "$1")
    assert df.where(~title_case(F.col("v")).eqNullSafe(always)).count() == 0
    assert "rlike" in str(title_case(F.col("v"))).lower()
