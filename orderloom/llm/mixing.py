"""Mixing sources to target weights by systematic sampling.

Within a source the documents stand in a row ordered by size; each has the same number of expected copies.
The running sum of expected copies, moved by one random offset of the source, crosses an integer as often as
the document is taken. Ordering by size keeps the taken words within about one long document of the target.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.text import WORD_PATTERN, free_name

SEED = "mix"
#: A source gives at most so many times its own size, and so does each of its documents.
MOST = 3
#: Rows that are numbered together among documents of one size.
ROWS_PER_RUN = 4096


@dataclass(frozen=True)
class Names:
    """Columns a mix is made from; the working columns have names of their own."""

    id_col: str = "doc_id"
    text_col: str = "text"
    source_col: str = "source"


def word_count(text_col: str) -> Column:
    """Number of words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(F.col(f"`{text_col}`").cast("string"), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source_key, source_size`` in, ``source_key, source_size, n_docs, target, offset`` out; one row per source.

    Sources in code point order weigh 1, 2, 3, repeating. Their shares add up to all sizes; no target is above ``MOST``
    times its source's size, and what is cut off is shared again by weight until none is above. That is one water level:
    with sources ordered by ``size / weight``, the first k of them stand at their limit, for the smallest k at which
    the level of the others stays below their limits.
    """
    everything = Window.orderBy("source_key")
    weighed = sizes.withColumn("weight", ((F.row_number().over(everything) - 1) % 3 + 1).cast("long"))
    by_limit = Window.orderBy(F.col("source_size") / F.col("weight"), "source_key")
    whole = Window.partitionBy()
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    levels = weighed.select(
        "*",
        F.sum("source_size").over(whole).alias("total"),
        (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("open_weight"),
        F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("closed_size"),
    ).withColumn("level", (F.col("total") - F.lit(MOST) * F.col("closed_size")).cast("double") / F.col("open_weight"))
    fits = F.col("level") * F.col("weight") <= (F.lit(MOST) * F.col("source_size")).cast("double")
    level = F.min(F.when(fits, F.struct(F.col("source_size") / F.col("weight"), F.col("source_key"), F.col("level")))).over(whole)["level"]
    limit = (F.lit(MOST) * F.col("source_size")).cast("double")
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{SEED}/offset/"), F.col("source_key"))), 1, 13), 16, 10).cast("double")
    return levels.select(
        "source_key",
        "source_size",
        F.least(level * F.col("weight"), limit).alias("target"),
        (offset / F.lit(float(1 << 52))).alias("offset"),
    )


def mix(docs: DataFrame, names: Names = Names()) -> DataFrame:
    """For every row: ``doc_id, size, source_size, target, copies, taken``.

    ``size`` is the number of words (null text: 0), ``copies`` how often the row is taken (0 to 3), ``taken`` the words
    taken from it. A null source is a source of its own, the last one. A null id is a key of its own. Rows that are
    alike in all columns take their copies in any order among themselves. A source without words has target 0 and
    gives no copies. Reruns agree. An empty table gives no rows.

    Places in the row of a source come from counts per size, then per run of documents of that size (a hash of the id
    parts them, so a size that a third of all rows share is many runs), then from a rank inside the run.
    """
    return _planned(docs, names).select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _planned(docs: DataFrame, names: Names, carry: bool = False) -> DataFrame:
    """Every row with its working columns and ``copies``. With ``carry``, ``row`` holds all its columns, and ``tie`` a hash of its text."""
    key = F.when(F.col(f"`{names.source_col}`").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(f"`{names.source_col}`").cast("string")))
    runs = max(1, -(-docs.count() // ROWS_PER_RUN))
    draw = F.md5(F.concat(F.lit(f"{SEED}/row/"), F.coalesce(F.col(f"`{names.id_col}`").cast("string"), F.lit("null"))))
    run = F.floor(F.conv(F.substring("draw", 1, 8), 16, 10).cast("long") * F.lit(runs) / F.lit(1 << 32))
    rows = docs.select(
        F.col(f"`{names.id_col}`").cast("long").alias("doc_id"),
        word_count(names.text_col).alias("size"),
        key.alias("source_key"),
        draw.alias("draw"),
        *([F.xxhash64(F.col(f"`{names.text_col}`").cast("string")).alias("tie"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []),
    ).withColumn("run", run)

    runs_of = rows.groupBy("source_key", "size", "run").agg(F.count(F.lit(1)).alias("n"))
    sizes_of = runs_of.groupBy("source_key", "size").agg(F.sum("n").alias("n"))
    per_source = sizes_of.groupBy("source_key").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    targets = source_targets(per_source)

    smaller = Window.partitionBy("source_key").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("source_key", "size").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    by_size = sizes_of.select("source_key", "size", F.coalesce(F.sum("n").over(smaller), F.lit(0)).alias("below"))
    by_run = runs_of.select("source_key", "size", "run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"))
    places = by_run.join(by_size, ["source_key", "size"]).join(targets, "source_key")

    inside = Window.partitionBy("source_key", "size", "run").orderBy("draw", "doc_id", *(["tie"] if carry else []))
    ranked = rows.withColumn("rank", F.row_number().over(inside).cast("long") - 1)
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    at = F.col("below") + F.col("ahead") + F.col("rank")
    # An expected number of exactly MOST copies must not gain or lose one by rounding.
    crossed = F.when(expected >= MOST, F.lit(MOST)).otherwise(
        F.floor((at + 1) * expected + F.col("offset")) - F.floor(at * expected + F.col("offset"))
    )
    return ranked.join(places, ["source_key", "size", "run"]).withColumn("copies", crossed.cast("long"))


def mixed_rows(docs: DataFrame, names: Names = Names()) -> DataFrame:
    """The rows of ``docs`` with all their columns, each as often as the mix takes it.

    Rows go through the mix whole, so rows of a repeated or null id are taken one by one. Where they have one size and
    source, they stand in the order of a hash of their text.
    """
    plan = _planned(docs, names, carry=True).where(F.col("copies") > 0)
    return plan.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
