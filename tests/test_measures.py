from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderloom.operators.parts import without_parts
from orderloom.functions import measures as m
from orderloom.functions.rounding import round_exact, round_half_away
from orderloom.plans import kpis


def test_rounding_is_half_away_from_zero(spark):
    df = spark.createDataFrame([(0.125,), (-0.125,), (0.005,), (-0.001,), (2.5,), (None,)], "x double")
    found = [r[0] for r in df.select(round_half_away(F.col("x"), 2)).collect()]
    assert found == [0.13, -0.13, 0.01, 0.0, 2.5, None]
    assert str(found[3]) == "0.0"
    assert df.select(round_half_away(F.lit(-2.5), 0)).first()[0] == -3.0
    exact = spark.createDataFrame([(Decimal("1.005"),)], "x decimal(10,3)")
    assert exact.select(round_exact(F.col("x"), 2)).first()[0] == 1.01


ALL = [
    m.lines("n"), m.filled("v", "filled"), m.units("f", "units"), m.money("v", "money"), m.mean("v", "mean"),
    m.rate("f", "rate"), m.complement_rate("f", "late"), m.ratio("v", "f", "ratio"), m.smallest("v", "low"),
    m.largest("v", "high"), m.lines_where("big", lambda: F.col("v") > 3, "big"),
    m.money_where("one", lambda: F.col("f") == 1, "v", "ones"), m.ratio_or_zero("v", "f", "rz"), m.quantity("f", "q"),
]


@pytest.fixture
def rows(spark):
    data = [(i % 5, "hot" if i % 3 == 0 else f"g{i % 4}", None if i % 7 == 0 else Decimal(i) / 10, i % 2) for i in range(300)]
    return spark.createDataFrame(data, "k int, g string, v decimal(12,2), f int").repartition(5)


def test_merged_parts_equal_one_pass(rows):
    whole = m.summarize(rows, ["g"], ALL).orderBy("g").collect()
    pieces = m.fold(rows, ["g", "k"], ALL)
    assert m.finish(m.merge(pieces, ["g"], ALL), ["g"], ALL).orderBy("g").collect() == whole


def test_folding_through_a_dimension_equals_join_then_group(spark, rows):
    dim = spark.createDataFrame([(0, "a"), (1, "a"), (2, "b"), (3, None)], "k int, label string")  # key 4 has no row
    joined = m.summarize(rows.join(dim, "k"), ["label"], ALL).orderBy("label").collect()
    folded = m.finish(m.fold_through(rows, "k", dim, ["label"], ALL), ["label"], ALL).orderBy("label").collect()
    assert folded == joined and len(joined) == 3


def test_distinct_counts_cannot_be_merged(rows):
    with pytest.raises(ValueError):
        m.merge(rows, ["g"], [m.distinct("v", "x")])


def test_zero_divisors(spark):
    df = spark.createDataFrame([("a", Decimal(5), 0)], "g string, v decimal(12,2), f int")
    row = m.summarize(df, ["g"], ALL).first()
    assert (row["ratio"], row["rz"]) == (None, 0.0)


def test_empty_input(spark, rows):
    row = m.summarize(rows.where("k > 100"), [], ALL).first()
    assert row["n"] == 0 and row["mean"] is None and row["rate"] is None and row["rz"] == 0.0


def test_turnover_is_null_when_costs_cancel_out(spark):
    df = spark.createDataFrame([(1, Decimal(3), Decimal(2)), (1, Decimal(3), Decimal(-2))], "p int, sales decimal(12,2), cost_per_order decimal(12,2)")
    assert m.summarize(df, ["p"], [m.ratio("sales", "cost_per_order", "t")]).first()["t"] is None


def test_all_kpis_from_shared_passes_equal_single_ones(spark, star):
    shared = kpis.results_from_parts(kpis.shared_parts(star))
    assert list(shared) == list(kpis.KPIS) and len(shared) == 27
    for name, df in shared.items():
        single = kpis.kpi(star, name)
        assert df.dtypes == single.dtypes, name
        assert df.collect() == single.collect(), name


def test_no_line_level_join_for_mergeable_kpis(star):
    """Customers and products meet keys, not order lines: the join input is already aggregated."""
    plan = kpis.kpi(without_parts(star), "kpi06_margin_by_segment")._jdf.queryExecution().optimizedPlan().toString()
    join_at = plan.index("Join Inner")
    assert "Aggregate [customer_id" in plan[join_at:]


def test_rounding_of_large_values_changes_nothing(spark):
    df = spark.createDataFrame([(5e17,), (-5e17,), (9.2e18,), (1e300,)], "x double")
    assert [r[0] for r in df.select(round_half_away(F.col("x"), 2)).collect()] == [5e17, -5e17, 9.2e18, 1e300]
