import statistics
from decimal import Context, Decimal
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderloom.operators import median
from orderloom.operators.clean import fill_nulls, fill_numeric_median
from orderloom.operators.median import approximate_medians, exact_medians


def _medians(df, columns):
    return {r["column"]: r["median"] for r in exact_medians(df, columns).collect()}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50), st.sampled_from([0, 1e9, -1e9, 0.25])), min_size=1, max_size=60))
def test_median_equals_statistics(spark, values):
    rows = [(None if v is None else float(v),) for v in values]
    known = [v for (v,) in rows if v is not None]
    expected = statistics.median(known) if known else None
    assert _medians(spark.createDataFrame(rows, "x double"), ["x"])["x"] == expected


def test_median_of_many_rows_and_one_dominant_value(spark):
    # A third of the rows share one value; the rest spreads over a wide skewed range.
    df = spark.range(30001).select(
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.pow(F.col("id").cast("double"), F.lit(3.0))).alias("skewed"),
        F.col("id").cast("double").alias("uniform"),
        F.lit(4).alias("constant"),
    )
    found = _medians(df, ["skewed", "uniform", "constant"])
    expected = df.agg(*[F.median(c).alias(c) for c in found]).first().asDict()
    assert found == expected


def test_incomplete_only_leaves_complete_columns_out(spark):
    df = spark.createDataFrame([(1, None), (3, 5)], "a int, b int")
    rows = {r["column"]: r["median"] for r in exact_medians(df, ["a", "b"], incomplete_only=True).collect()}
    assert rows == {"a": None, "b": 5.0}


def test_few_scans_and_complete_columns_stay_as_they_are(spark):
    df = spark.createDataFrame([(200000000000000001, 1, None), (7, 2, 4), (9, 2, 8)], "id bigint, n int, gap int")
    filled = fill_numeric_median(df)
    assert [f.dataType.simpleString() for f in filled.schema.fields] == ["bigint", "int", "decimal(11,1)"]
    assert sorted(map(tuple, filled.select("id", "n").collect())) == sorted(map(tuple, df.select("id", "n").collect()))
    assert sorted(float(r["gap"]) for r in filled.collect()) == [4.0, 6.0, 8.0]
    assert "Join" not in filled._jdf.queryExecution().optimizedPlan().toString()


def test_clustered_values_are_searched_digit_by_digit(spark, monkeypatch):
    monkeypatch.setattr(median, "FEW_VALUES", 3)
    monkeypatch.setattr(median, "DIGITS", 16)
    df = spark.range(4001).select((F.col("id") * F.col("id") * 1e-7 + F.when(F.col("id") == 4000, 1e9).otherwise(0.0)).alias("x"))
    assert _medians(df, ["x"])["x"] == 2000 * 2000 * 1e-7


def test_whole_numbers_beyond_doubles_are_told_apart(spark):
    df = spark.createDataFrame([(9007199254740993,), (9007199254740993,), (9007199254740993,), (None,)], "n bigint")
    assert {r["n"] for r in fill_numeric_median(df).collect()} == {Decimal("9007199254740993.0")}
    even = spark.createDataFrame([(9007199254740993,), (9007199254740994,), (None,)], "n bigint")
    assert Decimal("9007199254740993.5") in {r["n"] for r in fill_numeric_median(even).collect()}


def test_long_decimals_are_filled_whole(spark):
    big = Decimal("12345678901234.123456789")
    df = spark.createDataFrame([(big,), (big,), (None,), (Decimal("-0.000000001"),)], "x decimal(25,9)")
    assert [r["x"] for r in fill_numeric_median(df).collect()] == [big, big, big, Decimal("-0.000000001")]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1)),
            st.one_of(st.none(), st.integers(-(10**38) + 1, 10**38 - 1), st.integers(-9, 9)),
            st.one_of(st.none(), st.integers(-(10**25) + 1, 10**25 - 1)),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_selection_over_the_whole_span_of_a_type(spark, rows):
    small, few = median.DIGITS, median.FEW_VALUES
    median.DIGITS, median.FEW_VALUES = 64, 2
    try:
        scaled = [(a, None if b is None else Decimal(b).scaleb(-20, Context(prec=60)), None if c is None else Decimal(c).scaleb(-9, Context(prec=60))) for a, b, c in rows]
        found = median.median_values(spark.createDataFrame(scaled, "a bigint, b decimal(38,20), c decimal(25,9)"), ["a", "b", "c"])
    finally:
        median.DIGITS, median.FEW_VALUES = small, few
    for i, c in enumerate("abc"):
        known = sorted(Fraction(r[i]) for r in scaled if r[i] is not None)
        if known:
            assert Fraction(found[c]) == (known[(len(known) - 1) // 2] + known[len(known) // 2]) / 2
        else:
            assert found[c] is None


def test_input_is_read_three_times_at_most(spark, monkeypatch):
    monkeypatch.setattr(median, "FEW_VALUES", 2)
    monkeypatch.setattr(median, "DIGITS", 4)
    reads = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def seen(x):
        reads.add(1)
        return x

    seen = seen.asNondeterministic()
    df = spark.range(500, numPartitions=2).select(seen(F.col("id")).alias("n")).select((F.col("n") * 7919 % 104729).alias("n"), (F.col("n") * 0.5).alias("x"))
    expected = sorted(i * 7919 % 104729 for i in range(500))
    assert median.median_values(df, ["n", "x"]) == {"n": Decimal(expected[249] + expected[250]) / 2, "x": 124.75}
    assert reads.value <= 3 * 500


def test_infinite_values_and_nan(spark):
    inf, nan = float("inf"), float("nan")
    assert _medians(spark.createDataFrame([(inf,), (-inf,), (1.0,), (nan,)], "x double"), ["x"])["x"] == 1.0
    assert _medians(spark.createDataFrame([(inf,), (inf,), (1.0,)], "x double"), ["x"])["x"] == inf
    assert _medians(spark.createDataFrame([(5e-324,), (0.0,), (5e-324,)], "x double"), ["x"])["x"] == 5e-324


def test_fill_keeps_values_and_fills_with_midpoint(spark):
    df = spark.createDataFrame(
        [(1, "1.50", None, "x"), (4, "2.00", None, None), (None, None, None, "y"), (2, "9.99", None, "z")],
        "n int, m string, empty double, t string",
    ).withColumn("m", F.col("m").cast("decimal(12,2)"))
    rows = fill_nulls(df).collect()
    assert [float(r["n"]) for r in rows] == [1.0, 4.0, 2.0, 2.0]
    assert [str(r["m"]) for r in rows] == ["1.500", "2.000", "2.000", "9.990"]
    assert all(r["empty"] is None for r in rows)
    assert [r["t"] for r in rows] == ["x", "Unknown", "y", "z"]


def test_half_median_of_integers(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "n int")
    assert sorted(float(r["n"]) for r in fill_numeric_median(df).collect()) == [1.0, 1.5, 2.0]


def test_approximate_is_opt_in(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    assert approximate_medians(df, ["x"]).first()["median"] == pytest.approx(500, abs=1)


def test_no_numeric_column(spark):
    df = spark.createDataFrame([("a",)], "t string")
    assert fill_numeric_median(df).collect() == df.collect()
