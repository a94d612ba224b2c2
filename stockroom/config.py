"""Parameters shared by every operator: the reporting period and the ledger grains."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Period:
    """A closed calendar period ``[start, end]`` (both days included)."""

    start: _dt.date
    end: _dt.date

    def __post_init__(self) -> None:
        if self.start > self.end:
            raise ValueError(f"period start {self.start} is after its end {self.end}")

    @classmethod
    def of(cls, start: str | _dt.date, end: str | _dt.date) -> "Period":
        def as_date(v: str | _dt.date) -> _dt.date:
            return v if isinstance(v, _dt.date) else _dt.date.fromisoformat(v)

        return cls(as_date(start), as_date(end))

    @property
    def start_lit(self) -> Column:
        return F.lit(self.start)

    @property
    def end_lit(self) -> Column:
        return F.lit(self.end)

    def contains(self, date_col: Column | str) -> Column:
        c = F.col(date_col) if isinstance(date_col, str) else date_col
        return c.between(self.start_lit, self.end_lit)


# The period of the business questions, and the period used with the
# TPC-H-derived fixtures (one common and one leap year in both cases).
BUSINESS_PERIOD = Period(_dt.date(2019, 1, 1), _dt.date(2020, 12, 31))
FIXTURE_PERIOD = Period(_dt.date(1999, 1, 1), _dt.date(2000, 12, 31))

# Ledger grains. ProductRootCode does not determine Family, so the stock ledger is kept
# at two grains: product root per store (published tables) and family per store
# (denominator of the family/store turnover).
ROOT_GRAIN: tuple[str, ...] = ("ProductRootCode", "StoreId")
FAMILY_GRAIN: tuple[str, ...] = ("Family", "StoreId")

# Decimals that a price may have; sums are exact in these units and do not depend on the order
# rows are added in. A price that needs more decimals raises. The fixtures halve prices in cents.
DEFAULT_PRICE_SCALE = 2
FIXTURE_PRICE_SCALE = 3

# A dimension is broadcast only when its measured size is below this bound.
DEFAULT_BROADCAST_MAX_BYTES = 64 * 1024 * 1024
