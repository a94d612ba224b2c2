"""Row-level presence tests built from ``isNotNull`` (pushed into the Parquet scan) and ``isnan``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _missing(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def any_missing(df: DataFrame, cols: list[str] | None = None) -> Column:
    """True when any listed column is NULL (or NaN for floating columns)."""
    names = cols or df.columns
    return reduce(lambda a, b: a | b, [_missing(df, n) for n in names])


def all_present(df: DataFrame, cols: list[str] | None = None) -> Column:
    """Negation of :func:`any_missing`, written as a conjunction so each ``isNotNull`` is pushed down."""
    names = cols or df.columns
    terms = []
    for n in names:
        c = F.col(n)
        terms.append(c.isNotNull())
        if isinstance(df.schema[n].dataType, (T.FloatType, T.DoubleType)):
            terms.append(~F.isnan(c))
    return reduce(lambda a, b: a & b, terms)
