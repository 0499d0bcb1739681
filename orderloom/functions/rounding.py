"""One rounding rule for the whole package: half away from zero.

Spark rounds the decimal text of a double, other engines round its binary value, so
averages and ratios (doubles) go through ``round_half_away``; money sums stay DECIMAL
and are rounded exactly before the final cast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(x: Column, places: int) -> Column:
    """Round a double half away from zero; never yields -0.0."""
    scale = F.lit(10.0**places)
    # From 2^53 on, a double has no digits to round away, and floor would not fit a bigint.
    rounded = F.signum(x) * F.floor(F.abs(x) * scale + F.lit(0.5)) / scale + F.lit(0.0)
    return F.when(F.abs(x) * scale >= F.lit(2.0**53), x.cast("double")).otherwise(rounded)


def round_exact(x: Column, places: int) -> Column:
    """Round a DECIMAL (or integer) sum half away from zero and hand it over as DOUBLE."""
    return F.round(x, places).cast("double") + F.lit(0.0)
