"""Cleaning, quarantine and audit operators (C1, C2, C24-C29; C4 ``unmatched`` is with the joins).

Every audit returns a small DataFrame (one row or one row per column) so it can be written,
joined or asserted on like any other table; none of them collects data to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.functions.nulls import all_present, any_missing

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def clean(df: DataFrame) -> DataFrame:
    """Drop rows with a NULL in any column (or NaN in a floating column).

    Written as a conjunction of ``isNotNull`` terms, which Spark pushes into the Parquet scan.
    """
    return df.where(all_present(df))


def null_rejects(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """The quarantine, rows with a NULL (or NaN) in any of ``cols`` (default: all columns).

    With the default columns it is the exact complement of :func:`clean`, so no row is lost.
    """
    return df.where(any_missing(df, list(cols) if cols else None))


def table_shape(df: DataFrame) -> DataFrame:
    """One row, (Rows, Columns)."""
    return df.agg(F.count(F.lit(1)).alias("Rows")).select("Rows", F.lit(len(df.columns)).alias("Columns"))


def profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column, one row: Count, and for numeric columns Mean, sample StdDev, Min, Max
    (DOUBLE), for string columns MinText, MaxText (default: every numeric and string column).

    One pass over the data (a single global aggregate), then the wide row is turned into one
    row per column with ``explode``.
    """
    names = list(cols) if cols else [
        f.name for f in df.schema.fields if isinstance(f.dataType, (*_NUMERIC, T.StringType))
    ]
    if not names:
        raise ValueError("profile needs at least one numeric or string column")
    no_double, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    aggs, structs = [], []
    for i, n in enumerate(names):
        text = isinstance(df.schema[n].dataType, T.StringType)
        x = F.col(n) if text else F.col(n).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}")]
        if not text:
            aggs += [F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"sd{i}")]
        structs.append(
            F.struct(
                F.lit(n).alias("Column"),
                F.col(f"n{i}").alias("Count"),
                (no_double if text else F.col(f"mean{i}")).alias("Mean"),
                (no_double if text else F.col(f"sd{i}")).alias("StdDev"),
                (no_double if text else F.col(f"min{i}")).alias("Min"),
                (no_double if text else F.col(f"max{i}")).alias("Max"),
                (F.col(f"min{i}") if text else no_text).alias("MinText"),
                (F.col(f"max{i}") if text else no_text).alias("MaxText"),
            )
        )
    return df.agg(*aggs).select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def duplicate_products(products: DataFrame) -> DataFrame:
    """Product ids that occur more than once, with their number of rows. Each of their facts would
    be counted that many times by the enrichment."""
    return products.groupBy("ProductId").agg(F.count(F.lit(1)).alias("Rows")).where(F.col("Rows") > 1)


def date_range(df: DataFrame, col: str = "Date") -> DataFrame:
    """Earliest and latest date (``describe`` skips date columns)."""
    return df.agg(F.min(col).alias("MinDate"), F.max(col).alias("MaxDate"))


def _labelled_sums(parts: dict[str, DataFrame], value: str) -> DataFrame:
    """Global sums of ``value`` over several frames, one column per frame.

    Each frame is summed by itself, in the stage that makes its rows; the one-row sums are tagged and
    unioned, then pivoted with conditional sums: no cross join, and no row but these meets a tag.
    """
    tagged = None
    for label, frame in parts.items():
        t = frame.agg(F.sum(F.col(value).cast("long")).alias("_v")).select(F.lit(label).alias("_part"), "_v")
        tagged = t if tagged is None else tagged.unionByName(t)
    return tagged.agg(
        *[F.coalesce(F.sum(F.when(F.col("_part") == label, F.col("_v"))), F.lit(0)).alias(label) for label in parts]
    )


def reconcile_quantity(
    enriched_root: DataFrame, net_root: DataFrame, enriched_family: DataFrame, net_family: DataFrame
) -> DataFrame:
    """Sum of Quantity is conserved by netting and is the same at both ledger grains."""
    sums = _labelled_sums(
        {
            "EnrichedRoot": enriched_root,
            "NetRoot": net_root,
            "EnrichedFamily": enriched_family,
            "NetFamily": net_family,
        },
        "Quantity",
    )
    return sums.withColumn(
        "Balanced",
        (F.col("EnrichedRoot") == F.col("NetRoot"))
        & (F.col("NetRoot") == F.col("EnrichedFamily"))
        & (F.col("EnrichedFamily") == F.col("NetFamily")),
    )


def interval_days(iv: DataFrame) -> DataFrame:
    return iv.select("*", (F.datediff("EndDate", "StartDate") + 1).alias("_days"))


def reconcile_days(intervals: DataFrame, daily: DataFrame) -> DataFrame:
    """The days covered by the intervals equal the rows of the daily table."""
    sums = _labelled_sums(
        {
            "IntervalDays": interval_days(intervals).select(F.col("_days").alias("n")),
            "DailyRows": daily.select(F.lit(1).alias("n")),
        },
        "n",
    )
    return sums.withColumn("Balanced", F.col("IntervalDays") == F.col("DailyRows"))


def compare_grains(root: DataFrame, family: DataFrame) -> DataFrame:
    """Total daily stock of the two ledgers (expected to differ: clipping to positive
    stock happens at the ledger grain). Takes interval tables (summed as Stock x days per
    interval, without exploding them) or daily tables (Stock summed directly)."""

    def stock_days(df: DataFrame) -> DataFrame:
        if "StartDate" not in df.columns:
            return df.select(F.col("Stock").alias("s"))
        return interval_days(df).select((F.col("Stock") * F.col("_days")).alias("s"))

    sums = _labelled_sums({"RootStock": stock_days(root), "FamilyStock": stock_days(family)}, "s")
    return sums.withColumn("Differ", F.col("RootStock") != F.col("FamilyStock"))
