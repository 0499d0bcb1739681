"""Data-quality checks over the report base and the warehouse tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.measures import distinct, finish, lines, lines_where, mean, rate, summarize
from orderloom.operators.parts import DISTINCTS, PARTS, Grouping, Warehouse, batch_distincts, batch_parts, folded, united
from orderloom.schemas import FOREIGN_KEYS, PRIMARY_KEYS

CHECKS = (
    "total_records",
    "null_order_id",
    "null_sales",
    "negative_profit",
    "zero_sales",
    "duplicate_items",
)


def health_report(base: DataFrame, checks: Sequence[str] = CHECKS) -> DataFrame:
    """Rows ``(check, value, status)``; one aggregate over the columns the checks need."""
    distinct_items = F.count_distinct("order_item_id") + F.max(F.when(F.col("order_item_id").isNull(), 1).otherwise(0))
    values: dict[str, Column] = {
        "total_records": F.count(F.lit(1)),
        "null_order_id": F.count_if(F.col("order_id").isNull()),
        "null_sales": F.count_if(F.col("sales").isNull()),
        "negative_profit": F.count_if(F.col("profit") < 0),
        "zero_sales": F.count_if(F.col("sales") == 0),
        # Rows beyond the first of their key; missing keys are one key.
        "duplicate_items": F.coalesce(F.count(F.lit(1)) - distinct_items, F.lit(0)),
    }
    return _report(base.agg(*[values[c].cast("bigint").alias(c) for c in checks]), checks)


def _report(row: DataFrame, checks: Sequence[str]) -> DataFrame:
    value = F.col("value")
    status = (
        F.when(F.col("check").isin("negative_profit", "zero_sales"), "neutral")
        .when(F.col("check") == "total_records", F.when(value > 0, "good").otherwise("bad"))
        .otherwise(F.when(value == 0, "good").otherwise("bad"))
    )
    return row.unpivot([], list(checks), "check", "value").withColumn("status", status)


#: What the health report and the scorecard need of a batch of report rows.
BASE = Grouping(
    None,
    (),
    (
        lines("total_records"),
        lines_where("no_order", lambda: F.col("order_id").isNull(), "null_order_id"),
        lines_where("no_sales", lambda: F.col("sales").isNull(), "null_sales"),
        lines_where("loss", lambda: F.col("profit") < 0, "negative_profit"),
        lines_where("no_value", lambda: F.col("sales") == 0, "zero_sales"),
        lines_where("no_item", lambda: F.col("order_item_id").isNull(), "null_items"),
        distinct("order_item_id", "items"),
        *[(mean if c == "profit_margin_pct" else rate)(c, c, None) for c in ("on_time_flag", "is_fulfilled", "is_cancelled", "perfect_order_flag", "profit_margin_pct")],
    ),
)
#: Tables of a warehouse that the checks read instead of the fact, each written batch by batch.
BASE_PARTS, BASE_DISTINCTS, KEY_COUNTS = "dq_parts", "dq_distincts", "fk_counts"


def batch_quality(fact: DataFrame, base: DataFrame) -> dict[str, DataFrame]:
    """What one batch adds to the tables of the checks: partial figures and item ids of its report rows, and how often its
    fact rows use each foreign key."""
    rows, groupings = {"fact_orders": base}, united([BASE])
    keys = [
        fact.where(F.col(key).isNotNull()).groupBy(F.lit(key).alias("key_column"), F.col(key).cast("bigint").alias("key")).agg(F.count(F.lit(1)).alias("n"))
        for key in FOREIGN_KEYS
    ]
    return {
        BASE_PARTS: batch_parts(rows, groupings),
        BASE_DISTINCTS: batch_distincts(rows, groupings),
        KEY_COUNTS: reduce(DataFrame.unionByName, keys),
    }


def _stored_base(star: Mapping[str, DataFrame]) -> DataFrame:
    stored = Warehouse({PARTS: star[BASE_PARTS], DISTINCTS: star[BASE_DISTINCTS]})
    return finish(folded(stored, None, (), BASE.measures), (), BASE.measures)


def warehouse_health(star: Mapping[str, DataFrame], checks: Sequence[str] = CHECKS) -> DataFrame:
    """The health report of a whole warehouse, from what its batches have stored; the fact is not read."""
    repeated = F.col("total_records") - F.col("items") - F.when(F.col("null_items") > 0, 1).otherwise(0)
    return _report(_stored_base(star).select("*", repeated.alias("duplicate_items")).select(*[F.col(c).cast("bigint").alias(c) for c in checks]), checks)


def warehouse_scorecard(star: Mapping[str, DataFrame]) -> DataFrame:
    """The scorecard of a whole warehouse, from what its batches have stored."""
    return _cards(_stored_base(star))


# KPI, flag or percentage column, target, whether lower is better.
SCORECARD = (
    ("On-Time Delivery Rate", "on_time_flag", 70.0, False),
    ("Fulfillment Rate", "is_fulfilled", 90.0, False),
    ("Cancellation Rate", "is_cancelled", 5.0, True),
    ("Perfect Order Rate", "perfect_order_flag", 70.0, False),
    ("Avg Profit Margin", "profit_margin_pct", 15.0, False),
)


def scorecard(base: DataFrame) -> DataFrame:
    """KPI value against target; a value on its target is good, a missing one counts as 0."""
    known = [s for s in SCORECARD if s[1] in base.columns]
    measures = [(mean if c == "profit_margin_pct" else rate)(c, c, None) for _, c, _, _ in known]
    return _cards(summarize(base, [], measures) if known else base.agg(F.count(F.lit(1)).alias("_n")))


def _cards(row: DataFrame) -> DataFrame:
    cards = []
    for name, column, target, lower in SCORECARD:
        value = F.coalesce(F.col(column), F.lit(0.0)) if column in row.columns else F.lit(0.0)
        missed = value > target if lower else value < target
        status = F.when(missed, "AT RISK").otherwise("GOOD")
        cards.append(F.struct(F.lit(name).alias("kpi"), value.alias("value"), F.lit(target).alias("target"), status.alias("status")))
    return row.select(F.inline(F.array(*cards)))


def key_violations(star: Mapping[str, DataFrame]) -> DataFrame:
    """Number of repeated keys per dimension; also departments with more than one supplier row,
    which would multiply fact rows."""
    keys = [*PRIMARY_KEYS.items(), ("dim_suppliers", "department_id")]
    found = []
    for table, key in keys:
        repeated = star[table].groupBy(key).count().where("count > 1")
        found.append(
            repeated.agg(F.count(F.lit(1)).alias("repeated_keys")).select(
                F.lit(table).alias("table_name"), F.lit(key).alias("key_column"), "repeated_keys"
            )
        )
    return reduce(DataFrame.unionByName, found)


def foreign_key_orphans(star: Mapping[str, DataFrame]) -> DataFrame:
    """Fact rows per foreign key whose dimension row is missing.

    The fact is folded to one counted row per key before the anti join, so hot keys do not
    matter; a null key refers to nothing and is no orphan. A warehouse has those rows stored batch by batch, and the fact
    is not read.
    """
    found = []
    for key, table in FOREIGN_KEYS.items():
        if isinstance(star, Warehouse) and KEY_COUNTS in star:
            used = star[KEY_COUNTS].where(F.col("key_column") == key).groupBy(F.col("key").alias(key)).agg(F.sum("n").alias("n"))
        else:
            used = star["fact_orders"].where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        lost = used.join(star[table].select(key), key, "left_anti")
        found.append(
            lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows")).select(
                F.lit(key).alias("key_column"), F.lit(table).alias("table_name"), "orphan_rows"
            )
        )
    return reduce(DataFrame.unionByName, found)
