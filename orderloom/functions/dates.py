"""Date parsing and calendar parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_timestamp(c: Column, formats: Sequence[str]) -> Column:
    """First format that fits; null when none does (never an error)."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(fmt)) for fmt in formats])


def date_key(c: Column) -> Column:
    """Integer yyyyMMdd by arithmetic, without a text round trip; null for a null date."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def day_name(c: Column) -> Column:
    return F.date_format(c, "EEEE")


def month_name(c: Column) -> Column:
    return F.date_format(c, "MMMM")


def is_weekend(c: Column) -> Column:
    """1 on Saturday and Sunday (``weekday`` counts from Monday = 0)."""
    return F.weekday(c).isin(5, 6).cast("int")


def period_label(year: Column, month: Column) -> Column:
    """``YYYY-MM``."""
    return F.format_string("%d-%02d", year, month)
