"""What the catalog writes before a query runs, over small tables."""

import datetime as dt

import pytest

from orderloom import catalog, testdata
from orderloom.operators import star

DAY = dt.datetime(1996, 5, 1)
TABLES = {
    "region": ("r_regionkey int, r_name string", [(0, "ASIA"), (1, "EUROPE")]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "CHINA", 0), (1, "FRANCE", 1)]),
    "customer": ("c_custkey long, c_name string, c_nationkey int, c_mktsegment string", [(c, f"C{c}", c % 2, "AUTO") for c in range(1, 5)]),
    "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_retailprice double", [(p, f"part {p}", f"Brand#1{p % 3}", "PROMO", 9.5) for p in range(1, 8)]),
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string",
        [(o, o % 4 + 1, "FOP"[o % 3], DAY + dt.timedelta(days=40 * o), "2-HIGH") for o in range(1, 21)],
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
        [(o, (o * n) % 7 + 1, n, float(n), 100.25 * n, 0.05, 0.02, "RNA"[n % 3], "OF"[o % 2], DAY + dt.timedelta(days=40 * o + n)) for o in range(1, 21) for n in range(1, 4)],
    ),
}


@pytest.fixture
def tables(spark, tmp_path):
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def _rows(df):
    return sorted(map(str, df.collect()))


def test_queries_on_lines_do_not_build_the_warehouse(spark, tables):
    key = (spark.sparkContext.applicationId, tables)
    names = ("supplier_products", "scan_processed_products", "fact_orders", "fact_supplier_key", "fact_geo_key")
    alone = {n: _rows(catalog.QUERIES[n](spark, tables)) for n in names}
    assert key not in catalog._built
    w = catalog.warehouse_of(spark, tables)
    assert len(alone["fact_orders"]) == 60
    assert alone["fact_orders"] == _rows(catalog.published(star.build_fact(w["lines"], w["dim_suppliers"], w["dim_geography"])))
    assert alone == {n: _rows(catalog.QUERIES[n](spark, tables)) for n in names}


def test_lines_alone_are_those_of_the_warehouse(spark, tables):
    alone = catalog._lines(spark, tables)
    stored = catalog.warehouse_of(spark, tables)["lines"]
    assert alone.schema == stored.schema and _rows(alone) == _rows(stored)


def test_lines_alone_write_only_what_they_are_made_of(spark, tables):
    """Derived columns and copies of columns are not written before the tables that are asked for."""
    lines = catalog._lines(spark, tables)
    read = {p.rsplit("/", 2)[-2] for p in lines.inputFiles()}
    assert len(read) == 1 and read.pop().startswith("joined-")
    stored = catalog._stored(spark, tables, "joined", None)
    assert set(stored.columns) == set(testdata.JOINED_COLUMNS) and len(stored.columns) < len(lines.columns) / 2


def test_lines_of_an_order_are_brought_together_last(spark, tables):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = testdata.order_lines(spark, tables)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert "l_orderkey" in joins[0] and "l_partkey" in joins[1]
