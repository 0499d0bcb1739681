"""Keep-first rows and dense ids without gathering a group or a table in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DecimalType, IntegralType, StringType, TimestampNTZType, TimestampType

from orderloom.session import fresh_path


def keep_first(df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order``, then by all output columns (nulls first).

    The minimum of a struct combines on the map side, so a key with very many rows sends
    one row per task, where a ranking window would sort all of them in one task. A struct makes Spark sort what it folds,
    so rows that differ only in their place in the order are folded before, by hashing.
    """
    payload = [c for c in columns if c != key]
    sort = [c for c in order if c in df.columns and c not in payload and c != key]
    first = F.min(F.struct(*sort, *payload)).alias("_first")
    rows = _fold_order(df, [key, *payload], sort).groupBy(key).agg(first)
    return rows.select(*[F.col(key) if c == key else F.col(f"_first.{c}").alias(c) for c in columns])


# Values that are the same wherever they are equal, unlike 0.0 and -0.0, and of these the ones that a hash aggregate can hold.
_EXACT = (StringType, IntegralType, DecimalType, BooleanType, DateType, TimestampType, TimestampNTZType)
_HELD = _EXACT[1:]


def _fold_order(df: DataFrame, columns: Sequence[str], sort: Sequence[str]) -> DataFrame:
    """The smallest ``sort`` (null before all others) of each different row of ``columns``; as it is where it would not fold
    by hashing."""
    types = [df.schema[c].dataType for c in columns]
    if len(sort) != 1 or not isinstance(df.schema[sort[0]].dataType, _HELD) or not all(isinstance(t, _EXACT) for t in types):
        return df
    none = F.isnull(sort[0]).alias("_none")
    return df.groupBy(*columns, none).agg(F.min(sort[0]).alias(sort[0]))


def number_rows(df: DataFrame, order: Sequence[Column], buckets: Sequence[Column]) -> DataFrame:
    """Add ``_number`` 1..n in the order (buckets, order).

    Rows are ranked inside their bucket only; the start of each bucket is the running
    total of bucket sizes. The one unpartitioned window therefore sees one row per
    bucket, never the rows themselves.
    """
    rows, names = _bucketed(df, buckets)
    sizes = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_size"))
    return _placed(_ranked(rows, names, order), sizes, names, df.columns)


def number_rows_once(df: DataFrame, order: Sequence[Column], buckets: Sequence[Column], path: str | None = None) -> DataFrame:
    """As :func:`number_rows`, for input that must not be evaluated twice: costly, or with other rows the next time.

    The rows are written with their rank inside the bucket, the only job that reads the input; bucket sizes are the
    largest ranks of what was written. Runs at once. A caller that names the ``path`` of the written rows can drop it when
    it has read the result. There must be no more than some thousands of buckets: their starts are broadcast, so that the
    written rows are not shuffled to meet them.
    """
    rows, names = _bucketed(df, buckets)
    ranked = _ranked(rows, names, order)
    path = path or fresh_path(df.sparkSession, "ranked-rows")
    ranked.write.option("compression", "zstd").parquet(path)
    stored = df.sparkSession.read.schema(ranked.schema).parquet(path)
    sizes = stored.groupBy(*names).agg(F.max("_pos").cast("long").alias("_size"))
    return _placed(stored, sizes, names, df.columns, few=True)


def _bucketed(df: DataFrame, buckets: Sequence[Column]) -> tuple[DataFrame, list[str]]:
    names = [f"_b{i}" for i in range(len(buckets))]
    return df.select("*", *[b.alias(n) for b, n in zip(buckets, names)]), names


def _ranked(rows: DataFrame, names: list[str], order: Sequence[Column]) -> DataFrame:
    return rows.withColumn("_pos", F.row_number().over(Window.partitionBy(*names).orderBy(*order)))


def _placed(ranked: DataFrame, sizes: DataFrame, names: list[str], columns: Sequence[str], few: bool = False) -> DataFrame:
    """The rank inside a bucket behind the rows of all buckets before it; one row per bucket meets in a window. ``few``
    buckets are broadcast: Spark takes an aggregate to be as large as what it reads."""
    before = Window.orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*[F.col(n).alias(f"_s{n}") for n in names], F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    same_bucket = reduce(and_, [F.col(n).eqNullSafe(F.col(f"_s{n}")) for n in names])
    return ranked.join(F.broadcast(starts) if few else starts, same_bucket).select(*columns, (F.col("_start") + F.col("_pos")).alias("_number"))
