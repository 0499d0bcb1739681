"""Partial figures of each batch, stored and merged, so that KPIs and checks don't read the fact again.

Two tables grow by batches. ``kpi_parts`` holds, for each grouping and group, the sums, counts, minima and maxima that its
measures need. ``kpi_distincts`` holds the ids that an exact distinct count needs, as sets that can be merged: ids are cut
into ranges of 32,768, and a range of a group is a list of places where they are few, a bitmap of 4 KB where they are many.
An order that comes back in a later batch sets a place that is set already. Reading merges the sets range by range; a group
with a third of all ids is many ranges.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from orderloom.functions.measures import Measure, Part, fold, fold_through, merge_parts, parts_of
from orderloom.schemas import PRIMARY_KEYS

PARTS, DISTINCTS = "kpi_parts", "kpi_distincts"
#: Stored instead of being read off the fact; the last three belong to ``operators.quality``.
STORED = (PARTS, DISTINCTS, "dq_parts", "dq_distincts", "fk_counts")
#: Up to so many ids of a range are kept as a list.
FEW_PLACES = 1024

Star = Mapping[str, DataFrame]


class Warehouse(dict):
    """The tables of one version. Only for these are stored figures read: a copy with other tables (``{**star, ...}``) is a
    plain dict, whose figures come from its fact."""


def has_parts(star: Star) -> bool:
    return isinstance(star, Warehouse) and PARTS in star


@dataclass(frozen=True)
class Grouping:
    """Measures by ``keys``, of dimension ``through`` when given."""

    through: str | None
    keys: tuple[str, ...]
    measures: tuple[Measure, ...]

    @property
    def name(self) -> str:
        return grouping_name(self.through, self.keys)


def grouping_name(through: str | None, keys: Sequence[str]) -> str:
    return "_".join([through or "fact", *keys])


def united(groupings: Sequence[Grouping]) -> dict[str, Grouping]:
    """Groupings by name; those of one name share their measures."""
    out: dict[str, Grouping] = {}
    for g in groupings:
        before = out[g.name].measures if g.name in out else ()
        out[g.name] = Grouping(g.through, tuple(g.keys), before + tuple(g.measures))
    return out


def folded(star: Star, through: str | None, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Complete partial aggregates of a grouping: merged from stored parts where the star has them, else from the fact."""
    if has_parts(star):
        return _merged(star, through, keys, measures)
    if through is None:
        return fold(star["fact_orders"], list(keys), measures)
    return fold_through(star["fact_orders"], PRIMARY_KEYS[through], star[through], list(keys), measures)


def without_parts(star: Star) -> dict[str, DataFrame]:
    """The star with figures from its fact, as when rows of that are exchanged."""
    return {n: df for n, df in star.items() if n not in STORED}


# ── writing ──


def batch_parts(star: Star, groupings: Mapping[str, Grouping], bearing: Star = {}) -> DataFrame:
    """Rows of ``kpi_parts`` for the fact rows in ``star``. Groupings through a dimension of ``bearing`` read its rows, which
    bear the attributes of that dimension already (see ``star.bearing_rows``); the others join the dimension."""
    return _stacked([_sums(star, g, bearing).select(F.lit(name).alias("grouping"), "*") for name, g in groupings.items()])


def _sums(star: Star, g: Grouping, bearing: Star) -> DataFrame:
    plain = [p for p in parts_of(g.measures) if p.kind != "distinct"]
    measures = [Measure(p.name, (p,), lambda: F.lit(None)) for p in plain]
    if g.through in bearing:
        return fold(bearing[g.through], list(g.keys), measures)
    return folded(without_parts(star), g.through, g.keys, measures)


def batch_distincts(star: Star, groupings: Mapping[str, Grouping], bearing: Star = {}) -> DataFrame:
    """Rows of ``kpi_distincts``: ``grouping, key, what, bucket, places, bits`` for the fact rows in ``star``; ``bearing`` as for
    :func:`batch_parts`."""
    found = []
    for name, g in groupings.items():
        for part in parts_of(g.measures):
            if part.kind == "distinct":
                found.append(_ids(star, g, part, bearing).select(F.lit(name).alias("grouping"), "key", F.lit(part.name).alias("what"), "id"))
    ids = reduce(DataFrame.unionByName, found)
    bucket, place = F.bitmap_bucket_number("id"), F.bitmap_bit_position("id")
    whole = ["grouping", "key", "what", "bucket"]
    places = ids.select("grouping", "key", "what", bucket.alias("bucket"), place.cast("int").alias("place"))
    # Each task sends the places of a set as one list, without those it has seen; bitmaps are made where the lists have met.
    # Made where the lines lie, every task would send a bitmap of each range, and their number would grow with tasks times
    # ranges.
    sets = places.groupBy(*whole).agg(F.collect_set("place").alias("places"))
    few = F.size("places") <= FEW_PLACES
    lists = sets.select(*whole, F.when(few, F.col("places")).alias("places"), F.explode_outer(F.when(~few, F.col("places"))).alias("place"))
    bits = F.bitmap_construct_agg(F.col("place").cast("bigint"))
    return lists.groupBy(*whole).agg(F.first("places").alias("places"), F.when(F.count("place") > 0, bits).alias("bits"))


def _ids(star: Star, g: Grouping, part: Part, bearing: Star) -> DataFrame:
    """Ids of each group; an id may come several times. Lines are joined only to dimensions that no rows of ``bearing``
    stand for, which are small as a rule, so that Spark broadcasts them."""
    fact = bearing.get(g.through, star["fact_orders"])
    source = part.name.removeprefix("distinct_")
    if not isinstance(fact.schema[source].dataType, IntegralType):
        raise TypeError(f"{source}: only whole numbers have their place in a bitmap")
    joins = g.through is not None and g.through not in bearing
    given = fact.select(*(_link(g) if joins else g.keys), part.expr().cast("bigint").alias("id")).where("id IS NOT NULL")
    if joins:
        given = given.join(star[g.through].select(*_link(g), *[k for k in g.keys if k not in _link(g)]), _link(g))
    return given.select(_key(g.keys).alias("key"), "id")


def _link(g: Grouping) -> list[str]:
    return [PRIMARY_KEYS[g.through]] if g.through else []


def _key(keys: Sequence[str]) -> Column:
    """The group keys as one text; equal for equal keys, nulls included."""
    return F.to_json(F.struct(*keys)) if keys else F.lit("")


def _stacked(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# ── reading ──


def _merged(star: Star, through: str | None, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    name = grouping_name(through, keys)
    parts = parts_of(measures)
    stored = star[PARTS].where(F.col("grouping") == name)
    sums = merge_parts(stored, list(keys), [p for p in parts if p.kind != "distinct"])
    for part in parts:
        if part.kind == "distinct":
            counts = _counted(star[DISTINCTS].where((F.col("grouping") == name) & (F.col("what") == part.name)))
            counts = counts.select(F.col("key").alias("_key"), F.col("n").alias(part.name))
            same = _key(keys).eqNullSafe(F.col("_key"))
            sums = sums.join(counts, same, "left").drop("_key").withColumn(part.name, F.coalesce(part.name, F.lit(0)).cast("bigint"))
    return sums


def _counted(sets: DataFrame) -> DataFrame:
    """``key, n``: different ids of each group over all batches."""
    merged = sets.groupBy("key", "bucket").agg(
        F.bitmap_or_agg(F.coalesce("bits", F.unhex(F.lit("")))).alias("bits"),
        F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
        F.count("bits").alias("maps"),
    )
    # A place of a list counts where the bitmap of the range doesn't have it yet.
    byte = "conv(hex(substring(bits, p div 8 + 1, 1)), 16, 10)"
    fresh = F.expr(f"filter(places, p -> (shiftright(CAST({byte} AS INT), p % 8) & 1) = 0)")
    n = F.when(F.col("maps") == 0, F.size("places")).otherwise(F.bitmap_count("bits") + F.size(fresh))
    return merged.select("key", n.alias("n")).groupBy("key").agg(F.sum("n").alias("n"))
