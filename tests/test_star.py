import datetime as dt

from pyspark.sql import functions as F

from orderloom.operators.parts import without_parts
from orderloom.operators.star import coerce_fact_types
from orderloom.operators import quality, star
from orderloom.operators.keys import number_rows


def test_numbering_is_dense_and_sorted(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 3).alias("hot"))
    rows = number_rows(df, [F.col("k")], [F.floor(F.col("k") / 100)]).orderBy("k").collect()
    assert [r["_number"] for r in rows] == list(range(1, 5001))


def test_numbering_keeps_rows_with_null_buckets(spark):
    df = spark.createDataFrame([(None,), (2,), (None,), (1,)], "k int")
    rows = number_rows(df, [F.col("k")], [F.col("k")]).collect()
    assert sorted(r["_number"] for r in rows) == [1, 2, 3, 4]


def test_geography_drops_incomplete_places_and_numbers_the_rest(spark):
    rows = [("A", "r", "c", "x", "s"), ("A", "r", "c", None, "s"), ("A", "r", "c", "x", "s"), ("A", "r", "c", "b", "s")]
    df = spark.createDataFrame(rows, "market string, order_region string, order_country string, order_city string, order_state string")
    found = star.dim_geography(df).orderBy("geo_id").collect()
    assert [(r["geo_id"], r["order_city"]) for r in found] == [(1, "b"), (2, "x")]


def test_date_dimension(spark):
    days = [dt.datetime(2016, 1, 1, 10), dt.datetime(2016, 1, 1, 23), dt.datetime(2016, 1, 2), None]
    rows = star.dim_date(spark.createDataFrame([(d,) for d in days], "order_date timestamp")).orderBy("date_id").collect()
    assert [r["date_id"] for r in rows] == [20160101, 20160102]
    first, saturday = rows
    assert (first["year"], first["week"], first["is_weekend"], first["month_name"]) == (2016, 53, 0, "January")
    assert (saturday["day_of_week"], saturday["is_weekend"], saturday["quarter"]) == ("Saturday", 1, 1)


def test_department_with_two_names_is_reported(spark):
    orders = spark.createDataFrame([(1, "Golf"), (1, "Golf Shop"), (2, "Toys"), (None, "x")], "department_id bigint, department_name string")
    dims = {"dim_suppliers": star.dim_suppliers(orders)}
    for table, key in quality.PRIMARY_KEYS.items():
        dims.setdefault(table, spark.createDataFrame([(1,), (2,)], f"{key} bigint"))
    found = {(r["table_name"], r["key_column"]): r["repeated_keys"] for r in quality.key_violations(dims).collect()}
    assert found.pop(("dim_suppliers", "department_id")) == 1
    assert set(found.values()) == {0}


def test_missing_key_columns_give_null_keys(spark):
    orders = spark.createDataFrame([(1,)], "order_id bigint")
    none = spark.createDataFrame([(1,)], "geo_id bigint")
    assert star.with_supplier_key(orders, none).first()["supplier_id"] is None
    assert star.with_geo_key(orders, none).first()["geo_id"] is None


def test_unreadable_flags_and_amounts_become_zero(spark):
    df = spark.createDataFrame([("x", "1.5"), (None, "n/a"), ("1", None)], "is_cancelled string, sales string")
    rows = star.coerce_fact_types(df).collect()
    assert [(r["is_cancelled"], float(r["sales"])) for r in rows] == [(0, 1.5), (0, 0.0), (1, 0.0)]


def test_orphans_count_rows_not_keys(spark, star):
    fact = star["fact_orders"].select(
        *[F.when(F.col("order_id") % 2 == 0, F.lit(-1).cast("bigint")).otherwise(F.col(c)).alias(c) if c == "customer_id"
          else F.col(c) for c in star["fact_orders"].columns]
    )
    expected = fact.where("customer_id = -1").count()
    found = {r["key_column"]: r["orphan_rows"] for r in quality.foreign_key_orphans({**without_parts(star), "fact_orders": fact}).collect()}
    assert found["customer_id"] == expected and found["geo_id"] == 0


def test_join_kinds(spark, star):
    """A fact row without its dimension row drops out of the KPI and stays in the star join."""
    from orderloom.operators.star import star_join
    from orderloom.plans import kpis

    cut = {**star, "dim_products": star["dim_products"].where("category <> 'PROMO'")}
    n = star["fact_orders"].count()
    joined = star_join(cut, ["category"])
    assert joined.count() == n
    in_kpi = sum(r["total_orders"] for r in kpis.kpi(cut, "kpi09_perfect_order_by_category").collect())
    assert in_kpi == joined.where("category IS NOT NULL").count() < n


def test_flags_written_as_floats_are_read(spark):
    df = spark.createDataFrame([("1.0", "2e0"), ("0.0", "x"), (None, "12345678901.5")], "on_time_flag string, sales string")
    rows = coerce_fact_types(df).collect()
    assert [r["on_time_flag"] for r in rows] == [1, 0, 0]
    assert [float(r["sales"]) for r in rows] == [2.0, 0.0, 12345678901.5]


def _lines_with_contradictions(spark):
    schema = "customer_id bigint, product_id bigint, segment string, category string, product_name string, order_item_id bigint"
    rows = [
        (1, 10, "A", "x", "p", 1),
        (1, 10, "A", "x", "p", 2),
        (2, 10, "B", "x", "q", 3),  # another name for product 10
        (2, 11, None, "y", "r", 4),  # customer 2 without a segment
        (3, None, "C", "z", "s", 5),
        (None, 11, "D", "y", "r", 6),
        (4, 12, "E", "w", "t", 7),  # a product the dimension doesn't know
    ]
    return spark.createDataFrame(rows, schema)


def _small_star(spark, fact):
    return {
        "fact_orders": fact,
        "dim_customers": spark.createDataFrame([(1, "A"), (2, "B"), (3, "C"), (4, "F")], "customer_id bigint, segment string"),
        "dim_products": spark.createDataFrame([(10, "x", "p"), (11, "y", "r")], "product_id bigint, category string, product_name string"),
    }


def test_corrections_are_the_keys_whose_lines_contradict(spark):
    lines = _lines_with_contradictions(spark)
    w = _small_star(spark, lines)
    customers = star.line_corrections(lines, w["dim_customers"], "dim_customers").collect()
    products = star.line_corrections(lines, w["dim_products"], "dim_products").collect()
    assert sorted(tuple(r) for r in customers) == [(2, "B"), (4, "F")]
    assert sorted(tuple(r) for r in products) == [(10, "x", "p"), (12, None, None)]
    assert star.line_corrections(lines.drop("segment"), w["dim_customers"], "dim_customers") is None


def test_corrected_lines_bear_what_the_join_gives(spark, monkeypatch):
    lines = _lines_with_contradictions(spark)
    w = _small_star(spark, lines)
    monkeypatch.setattr(star, "FACT_COLUMNS", ("order_item_id", "customer_id", "product_id"))
    attributes = ["segment", "category", "product_name"]
    joined = star.star_join({**w, "fact_orders": lines.drop(*attributes)}, attributes).collect()
    fixed = {d: star.line_corrections(lines, w[d], d) for d in star.LARGE_DIMENSIONS}
    corrected = star.star_join(w, attributes, fixed).collect()
    assert sorted(map(str, corrected)) == sorted(map(str, joined))


def test_id_sets_are_shuffled_once_and_not_as_bitmaps(spark, sf):
    from orderloom.catalog import warehouse_of
    from orderloom.operators.parts import batch_distincts
    from orderloom.plans.warehouse import KPI_GROUPINGS

    sets = batch_distincts(dict(warehouse_of(spark, sf)), KPI_GROUPINGS)
    plan = sets._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(grouping") == 1


def test_shuffle_files_go_with_their_job(spark):
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
    counted = spark.range(100).groupBy(F.col("id") % 7).count().repartition(3)
    assert sorted(counted.collect()) == sorted(counted.collect())  # what is asked again is computed again
