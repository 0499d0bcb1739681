"""Measures that can be computed in steps.

A ``Measure`` names the partial aggregates it needs and how its value is read off them.
Sums, counts, minima and maxima of disjoint pieces can be merged, so the same measure
works in one ``groupBy`` (``summarize``), through a dimension after the fact has been
folded to one row per foreign key (``summarize_through``), and over batches that were
aggregated on different days (``fold`` / ``merge``). Averages are kept as sum and count
until the very end: no average of averages, no order-dependent float sum.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.rounding import round_exact, round_half_away

# kind -> (aggregate over rows, aggregate over partial results)
_STEPS: dict[str, tuple[Callable, Callable | None]] = {
    "sum": (F.sum, F.sum),
    "count": (F.count, F.sum),
    "min": (F.min, F.min),
    "max": (F.max, F.max),
    "distinct": (F.count_distinct, None),
}


@dataclass(frozen=True)
class Part:
    """One partial aggregate: its column name, kind and row expression."""

    name: str
    kind: str
    expr: Callable[[], Column]


@dataclass(frozen=True)
class Measure:
    name: str
    parts: tuple[Part, ...]
    value: Callable[[], Column]

    @property
    def mergeable(self) -> bool:
        return all(p.kind != "distinct" for p in self.parts)


def _sum(col: str) -> Part:
    return Part(f"sum_{col}", "sum", lambda: F.col(col))


def _count(col: str) -> Part:
    return Part(f"count_{col}", "count", lambda: F.col(col))


def _lines() -> Part:
    return Part("count_lines", "count", lambda: F.lit(1))


def _double(name: str) -> Column:
    return F.col(name).cast("double")


def lines(name: str) -> Measure:
    """Number of rows."""
    return Measure(name, (_lines(),), lambda: F.col("count_lines"))


def filled(col: str, name: str) -> Measure:
    """Number of rows where ``col`` is not null."""
    return Measure(name, (_count(col),), lambda: F.col(f"count_{col}"))


def distinct(col: str, name: str) -> Measure:
    """Exact number of different non-null values."""
    part = Part(f"distinct_{col}", "distinct", lambda: F.col(col))
    return Measure(name, (part,), lambda: F.col(part.name))


def units(col: str, name: str) -> Measure:
    """Sum of an integer column."""
    return Measure(name, (_sum(col),), lambda: F.col(f"sum_{col}").cast("bigint"))


def quantity(col: str, name: str) -> Measure:
    """Sum of a quantity: a double, because a missing quantity may have been filled with a half."""
    return Measure(name, (_sum(col),), lambda: _double(f"sum_{col}"))


def money(col: str, name: str, places: int | None = 2) -> Measure:
    """Sum of a money column; exact until the last step."""
    if places is None:
        return Measure(name, (_sum(col),), lambda: _double(f"sum_{col}"))
    return Measure(name, (_sum(col),), lambda: round_exact(F.col(f"sum_{col}"), places))


def mean(col: str, name: str, places: int | None = 2, scale: float = 1.0) -> Measure:
    """Average over non-null values, times ``scale``; null when there are none."""

    def value() -> Column:
        avg = F.try_divide(_double(f"sum_{col}"), _double(f"count_{col}"))
        if scale != 1.0:
            avg = avg * F.lit(scale)
        return avg if places is None else round_half_away(avg, places)

    return Measure(name, (_sum(col), _count(col)), value)


def rate(flag: str, name: str, places: int | None = 2) -> Measure:
    """Share of rows with the 0/1 flag set, in percent."""
    return mean(flag, name, places, scale=100.0)


def complement_rate(flag: str, name: str) -> Measure:
    """100 % minus ``rate``, rounded once."""

    def value() -> Column:
        avg = F.try_divide(_double(f"sum_{flag}"), _double(f"count_{flag}"))
        return round_half_away((F.lit(1.0) - avg) * F.lit(100.0), 2)

    return Measure(name, (_sum(flag), _count(flag)), value)


def share_of_lines(flag: str, name: str) -> Measure:
    """Sum of a flag over the number of non-null order ids, in percent."""

    def value() -> Column:
        return round_half_away(F.try_divide(_double(f"sum_{flag}"), _double("count_order_id")) * F.lit(100.0), 2)

    return Measure(name, (_sum(flag), _count("order_id")), value)


def ratio(top: str, bottom: str, name: str, scale: float = 1.0, places: int | None = 2) -> Measure:
    """Quotient of two sums; null when the bottom sum is zero or null."""

    def value() -> Column:
        q = F.try_divide(_double(f"sum_{top}"), F.nullif(_double(f"sum_{bottom}"), F.lit(0.0)))
        if scale != 1.0:
            q = q * F.lit(scale)
        return q if places is None else round_half_away(q, places)

    return Measure(name, (_sum(top), _sum(bottom)), value)


def per_distinct(top: str, key: str, name: str) -> Measure:
    """Sum of an integer column per different key."""
    part = Part(f"distinct_{key}", "distinct", lambda: F.col(key))
    return Measure(
        name,
        (_sum(top), part),
        lambda: round_half_away(F.try_divide(_double(f"sum_{top}"), _double(part.name)), 2),
    )


def smallest(col: str, name: str) -> Measure:
    return Measure(name, (Part(f"min_{col}", "min", lambda: F.col(col)),), lambda: round_exact(F.col(f"min_{col}"), 2))


def largest(col: str, name: str) -> Measure:
    return Measure(name, (Part(f"max_{col}", "max", lambda: F.col(col)),), lambda: round_exact(F.col(f"max_{col}"), 2))


def lines_where(label: str, condition: Callable[[], Column], name: str) -> Measure:
    """Number of rows that meet a condition."""
    part = Part(f"where_{label}", "sum", lambda: F.when(condition(), 1).otherwise(0))
    return Measure(name, (part,), lambda: F.col(part.name).cast("bigint"))


def money_where(label: str, condition: Callable[[], Column], col: str, name: str) -> Measure:
    """Money sum over the rows that meet a condition; other rows count as zero."""
    part = Part(f"where_{label}_{col}", "sum", lambda: F.when(condition(), F.col(col)).otherwise(F.lit(0).cast("int")))
    return Measure(name, (part,), lambda: round_exact(F.col(part.name), 2))


def parts_of(measures: Sequence[Measure]) -> list[Part]:
    """The partial aggregates that some measures need, each once."""
    unique: dict[str, Part] = {}
    for m in measures:
        for p in m.parts:
            unique.setdefault(p.name, p)
    return list(unique.values())


def fold(df: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Partial aggregates per key."""
    aggs = [_STEPS[p.kind][0](p.expr()).alias(p.name) for p in parts_of(measures)]
    return df.groupBy(*keys).agg(*aggs)


def merge(folded: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Combine partial aggregates into fewer keys."""
    for m in measures:
        if not m.mergeable:
            raise ValueError(f"{m.name} counts distinct values and cannot be merged")
    return merge_parts(folded, keys, parts_of(measures))


def merge_parts(folded: DataFrame, keys: Sequence[str], parts: Sequence[Part]) -> DataFrame:
    """Combine the given partial aggregates into fewer keys; without any, only the keys are left."""
    aggs = [_STEPS[p.kind][1](p.name).alias(p.name) for p in parts]
    return folded.groupBy(*keys).agg(*aggs) if aggs else folded.select(*keys).distinct()


def finish(folded: DataFrame, keys: Sequence[str] | Mapping[str, str], measures: Sequence[Measure]) -> DataFrame:
    """Read the measure values off complete partial aggregates; ``keys`` may rename."""
    names = keys if isinstance(keys, Mapping) else {k: k for k in keys}
    return folded.select(
        *[F.col(k).alias(out) for k, out in names.items()],
        *[m.value().alias(m.name) for m in measures],
    )


def distinct_count(df: DataFrame, col: str) -> Column:
    """Number of different non-null values of one column, as a one-row subquery.

    Several distinct counts in one aggregate would repeat every row for each of them; a subquery reads its own column
    only.
    """
    values = df.select(F.col(col).alias("value")).where("value IS NOT NULL").distinct()
    return values.agg(F.count(F.lit(1)).alias("n")).scalar()


def summarize(df: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Group once and compute the measures; over the whole table, several distinct counts are each counted by themselves."""
    apart = {p.name: p for m in measures for p in m.parts if p.kind == "distinct"}
    if keys or len(apart) < 2:
        return finish(fold(df, keys, measures), keys, measures)
    rest = [m for m in measures if not any(p.kind == "distinct" for p in m.parts)]
    row = fold(df, [], rest) if rest else df.agg(F.count(F.lit(1)).alias("_n"))
    counts = {name: distinct_count(df, name.removeprefix("distinct_")) for name in apart}
    return finish(row.withColumns(counts), keys, measures)


def fold_through(
    fact: DataFrame, link: str, dim: DataFrame, keys: Sequence[str], measures: Sequence[Measure]
) -> DataFrame:
    """Partial aggregates per attribute of a dimension.

    Mergeable measures are first folded to one row per foreign key, with map-side
    combine, so a key that holds a third of the fact arrives as one row per task and the
    join sees keys, not order lines. A distinct count needs the lines; there Spark joins
    first, by broadcast below its size threshold and by a skew-splitting sort-merge join
    above it.
    """
    side = dim.select(link, *keys)
    if all(m.mergeable for m in measures):
        per_key = fold(fact.where(F.col(link).isNotNull()), [link], measures)
        return merge(per_key.join(side, link), keys, measures)
    return fold(fact.join(side, link), keys, measures)


def ratio_or_zero(top: str, bottom: str, name: str, scale: float = 100.0) -> Measure:
    """Quotient of two sums, unrounded; 0 unless the bottom sum is positive."""

    def value() -> Column:
        q = F.try_divide(_double(f"sum_{top}"), _double(f"sum_{bottom}")) * F.lit(scale)
        return F.when(F.col(f"sum_{bottom}") > 0, q).otherwise(F.lit(0.0))

    return Measure(name, (_sum(top), _sum(bottom)), value)
