"""Calendar arithmetic on DateType columns.

Dates are kept as DateType everywhere: day arithmetic on dates does not depend on the
session time zone, whereas a daily ``sequence`` over timestamps does across DST changes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_first_day(year: Column | str) -> Column:
    return F.make_date(_c(year), F.lit(1), F.lit(1))


def year_last_day(year: Column | str) -> Column:
    return F.make_date(_c(year), F.lit(12), F.lit(31))


def days_in_year(year: Column | str) -> Column:
    """Calendar days of a year (366 in leap years, else 365), as INT."""
    y = _c(year)
    return F.datediff(year_first_day(y + 1), year_first_day(y))


def overlap_days(start: Column | str, end: Column | str, lo: Column, hi: Column) -> Column:
    """Days shared by the closed ranges [start, end] and [lo, hi]; may be <= 0 when disjoint."""
    return F.datediff(F.least(_c(end), hi), F.greatest(_c(start), lo)) + 1


def as_timestamp(date_col: Column | str) -> Column:
    """Midnight of a date in the session time zone (the published contract types dates as timestamps)."""
    return _c(date_col).cast("timestamp")
