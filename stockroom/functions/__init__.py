"""Column-level helpers: dates, money and null tests. All are built-in Spark expressions."""

from stockroom.functions.dates import (
    as_timestamp,
    days_in_year,
    overlap_days,
    year_first_day,
    year_last_day,
)
from stockroom.functions.money import money, money_to_double
from stockroom.functions.nulls import all_present, any_missing

__all__ = [
    "all_present",
    "any_missing",
    "as_timestamp",
    "days_in_year",
    "money",
    "money_to_double",
    "overlap_days",
    "year_first_day",
    "year_last_day",
]
