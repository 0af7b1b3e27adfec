"""Date and time column expressions (all JVM-side, codegen-friendly)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Civil time zone in which opt-in instants are turned into signup dates.
MARKET_TZ = "America/New_York"

# A Sunday; weeks below are counted in Sunday-to-Saturday blocks from here.
SUNDAY_EPOCH = dt.date(1970, 1, 4)


def ntz_midnight(d: dt.date) -> Column:
    """A DATE as a TIMESTAMP_NTZ literal (matches a DATETIME column in type,
    so the comparison is pushed down to the Parquet scan)."""
    # DATE -> TIMESTAMP_NTZ is midnight in every zone; a Python datetime
    # literal would pass through the Python process's local zone
    return F.lit(d).cast("timestamp_ntz")


def local_date(ts: Column, tz: str = MARKET_TZ) -> Column:
    """Instant -> civil date in ``tz``.

    ``convert_timezone`` with the session zone as source reads the instant as
    session-local wall time and re-expresses it in ``tz``; the result is a
    TIMESTAMP_NTZ, so ``to_date`` no longer depends on the session zone.
    """
    return F.to_date(F.convert_timezone(None, F.lit(tz), ts))


def sunday_week(d: Column) -> Column:
    """Index of the Sunday-started week containing ``d``.

    Differences of this index count the week boundaries crossed between two
    dates (Saturday -> Sunday is one), which is what week-granular date
    differences in the reference's warehouse compute.
    """
    return F.floor(F.datediff(d, F.lit(SUNDAY_EPOCH)) / F.lit(7))


def week_boundaries_between(later: Column, earlier: Column) -> Column:
    return sunday_week(later) - sunday_week(earlier)
