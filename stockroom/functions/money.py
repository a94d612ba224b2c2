"""Exact money arithmetic.

Prices arrive as FLOAT, DOUBLE or DECIMAL. Multiplying and summing them as floating point makes a
total depend on the order partitions are added in (and drifts: on 100 M rows a DOUBLE sum was off by
~1.7 k). Prices are therefore carried as LONG *minor units* of ``scale`` decimals (cents for scale 2).
A price must have an exact value there: one that is not finite, or that needs more decimals (a FLOAT or
DOUBLE whose DECIMAL form does not convert back to it, a DECIMAL of a finer scale), raises instead of
being rounded. Every per-row product and every sum is then exact
LONG arithmetic (ANSI mode raises on overflow instead of wrapping), about 18x cheaper than
per-row DECIMAL arithmetic, which Spark runs on BigDecimal objects once precision exceeds 18.
Per-group totals are converted once, at the end, to an exact DECIMAL or to DOUBLE.

The DOUBLE of a total is the correctly rounded value of the exact amount, the same number
CAST(exact_decimal AS DOUBLE) gives in any engine.
"""

from __future__ import annotations

import decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.config import DEFAULT_PRICE_SCALE

#: Digits before the decimal point that a price may have, besides those of its scale.
WHOLE_DIGITS = 13


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def price_scale_of(products: DataFrame, default: int = DEFAULT_PRICE_SCALE) -> int:
    """The scale that holds the prices of ``products``: the finest of its DECIMAL prices, at least ``default``."""
    kinds = [products.schema[c].dataType for c in ("RetailPrice", "SupplierPrice")]
    return max([default, *(k.scale for k in kinds if isinstance(k, T.DecimalType))])


def money(df: DataFrame, price: str, scale: int = DEFAULT_PRICE_SCALE) -> Column:
    """The price column of ``df`` as an exact DECIMAL with ``scale`` decimals; raises where it has none."""
    kind, value = df.schema[price].dataType, F.col(price)
    # try_cast: what does not fit is reported below, whatever the session's ANSI setting
    exact = value.try_cast(f"decimal({WHOLE_DIGITS + scale},{scale})")
    same = F.coalesce(exact.cast(kind) == value, F.lit(False))
    if isinstance(kind, T.DecimalType):
        same = F.coalesce(exact == value, F.lit(False))
    missing = value.isNull()
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        missing = missing | F.isnan(price)
    problem = F.raise_error(F.concat(F.lit(f"{price} "), value.cast("string"), F.lit(f" has no exact value with {scale} decimals; give a larger price_scale")))
    return F.when(missing, F.lit(None)).when(same, exact).otherwise(problem)


def price_units(df: DataFrame, price: str, scale: int = DEFAULT_PRICE_SCALE) -> Column:
    """The price in exact minor units (10^-scale) as LONG, e.g. 12.34 -> 1234 for scale 2.

    Meant to be computed once per product on the (small) dimension side of a join.
    """
    factor = F.lit(10**scale).cast(f"decimal({scale + 1},0)")
    return (money(df, price, scale) * factor).cast("long")


def units_to_decimal(units: Column | str, scale: int = DEFAULT_PRICE_SCALE) -> Column:
    """Minor units (LONG) -> exact DECIMAL(38, scale)."""
    step = F.lit(decimal.Decimal(1).scaleb(-scale))
    return _c(units).cast("decimal(38,0)") * step


def units_to_double(units: Column | str, scale: int = DEFAULT_PRICE_SCALE) -> Column:
    """Minor units (LONG) -> DOUBLE, correctly rounded (via the exact decimal; non-null in, non-null out)."""
    return units_to_decimal(units, scale).cast("double")


def money_to_double(amount: Column | str) -> Column:
    return _c(amount).cast("double")
