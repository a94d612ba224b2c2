"""The stock ledger (C5-C14): from movements to closed intervals of stock and daily stock.

``grain`` is the ledger key: ``ROOT_GRAIN`` (ProductRootCode, StoreId) or ``FAMILY_GRAIN``
(Family, StoreId). All windows are ``partitionBy(*grain).orderBy("Date")``.

Scale notes
-----------
* Movements are first netted per (grain, Date) with a grouped ``sum``. Spark aggregates
  partially inside each map task before the shuffle, so a key holding a large share of all
  movements sends at most one row per (key, day, map task) across the network.
* After netting a key has at most one row per calendar day of its history. That is the
  largest partition any ledger window ever sees, independent of data volume; a hot key
  cannot make a window task grow with the data.
* Every ledger window shares one partitioning (hash of the grain), so after the netting
  exchange there is exactly one more exchange, however many window steps follow.

The step-by-step operators mirror the business rules one at a time (and are what the audits
use); :func:`ledger` computes the published intervals in one window pass.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from stockroom.config import Period


def _by_date(grain: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*grain).orderBy("Date")


def _running(grain: Sequence[str]) -> WindowSpec:
    return _by_date(grain).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def net_movements(movements: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Net Quantity per key and day (LONG)."""
    return movements.groupBy(*grain, "Date").agg(F.sum("Quantity").cast("long").alias("Quantity"))


def running_stock(net: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Stock = cumulative net quantity over the whole history of the key, in date order."""
    return net.select(*grain, "Date", "Quantity", F.sum("Quantity").over(_running(grain)).alias("Stock"))


def opening_stock(stock: DataFrame, grain: Sequence[str], start: dt.date) -> DataFrame:
    """The balance as of ``start`` (last row dated on or before it), re-dated to ``start``.

    A movement on the start day is part of the opening. Keys without history on or before
    ``start`` have no opening row.
    """
    return (
        stock.where(F.col("Date") <= F.lit(start))
        .groupBy(*grain)
        .agg(F.max_by("Stock", "Date").alias("Stock"))
        .select(*grain, F.lit(start).alias("Date"), "Stock")
    )


def stock_timeline(stock: DataFrame, grain: Sequence[str], start: dt.date) -> DataFrame:
    """Opening row plus every change after ``start``, in one pass.

    A row is kept when the state it sets still holds after ``start``: its next change is
    after ``start`` (or it has none). Among rows dated on or before ``start`` that is only
    the last one, the opening balance, which is re-dated to ``start``.
    """
    nxt = F.lead("Date").over(_by_date(grain))
    return (
        stock.select(*grain, "Date", "Stock", nxt.alias("_next"))
        .where(F.col("_next").isNull() | (F.col("_next") > F.lit(start)))
        .select(*grain, F.greatest(F.col("Date"), F.lit(start)).alias("Date"), "Stock")
    )


def _with_key_flags(timeline: DataFrame, grain: Sequence[str], start: dt.date) -> DataFrame:
    w = Window.partitionBy(*grain)
    rows = F.count(F.lit(1)).over(w)
    non_negative = F.sum(F.when(F.col("Stock") >= 0, 1).otherwise(0)).over(w)
    lone_zero = (rows == 1) & (F.col("Stock") == 0) & (F.col("Date") == F.lit(start))
    return timeline.select(
        *timeline.columns,
        F.when(lone_zero, F.lit("lone_zero_opening"))
        .when(non_negative == 0, F.lit("all_negative"))
        .alias("Reason"),
    )


def prunable_keys(timeline: DataFrame, grain: Sequence[str], start: dt.date) -> DataFrame:
    """C9 (audit): rows of keys whose only row is a zero opening balance, or whose stock is
    negative on every row. Such keys never reach the positive intervals."""
    return _with_key_flags(timeline, grain, start).where(F.col("Reason").isNotNull())


def active_timeline(timeline: DataFrame, grain: Sequence[str], start: dt.date) -> DataFrame:
    """The timeline without the rows reported by :func:`prunable_keys`."""
    return _with_key_flags(timeline, grain, start).where(F.col("Reason").isNull()).drop("Reason")


def change_intervals(timeline: DataFrame, grain: Sequence[str], end: dt.date) -> DataFrame:
    """C11: each change row becomes [StartDate, EndDate], EndDate = day before the next change,
    or ``end`` for the last one. Changes after ``end`` are cut first, so they never matter."""
    nxt = F.lead("Date").over(_by_date(grain))
    return timeline.where(F.col("Date") <= F.lit(end)).select(
        *grain,
        F.col("Date").alias("StartDate"),
        F.coalesce(F.date_sub(nxt, 1), F.lit(end)).alias("EndDate"),
        "Stock",
    )


def positive_intervals(intervals: DataFrame) -> DataFrame:
    """Intervals with Stock > 0 (the published ``interval_stock``)."""
    return intervals.where(F.col("Stock") > 0)


def nonpositive_intervals(intervals: DataFrame) -> DataFrame:
    """C13 (audit): intervals with Stock <= 0."""
    return intervals.where(F.col("Stock") <= 0)


def ledger(movements: DataFrame, grain: Sequence[str], period: Period, colocate: bool = False) -> DataFrame:
    """C5-C8, C11, C12 fused: positive-stock intervals per key inside ``period``.

    ``movements`` needs the grain columns, Date and Quantity (raw movements or an already
    netted table). Movements after the period end are cut before netting: the running sum at
    a date only depends on earlier rows and the last interval closes at the period end anyway.
    One window pass computes the running Stock and the next change date.

    ``colocate=True`` hashes the input by the grain once, so netting and the window share a
    single exchange. It skips the map-side pre-aggregation, so use it only when the rows of one
    key are already bounded, e.g. a table summed per (finer key, day) whose finer key has a
    bounded fan-in into the grain; on raw movements keep the default (two exchanges, the first
    after a partial sum in every map task).
    """
    start, end = period.start_lit, period.end_lit
    cut = movements.where(F.col("Date") <= end)
    if colocate:
        cut = cut.repartition(*grain)
    net = net_movements(cut, grain)
    by_date = _by_date(grain)
    return (
        net.select(
            *grain,
            "Date",
            F.sum("Quantity").over(_running(grain)).alias("Stock"),
            F.lead("Date").over(by_date).alias("_next"),
        )
        .where((F.col("_next").isNull() | (F.col("_next") > start)) & (F.col("Stock") > 0))
        .select(
            *grain,
            F.greatest(F.col("Date"), start).alias("StartDate"),
            F.coalesce(F.date_sub("_next", 1), end).alias("EndDate"),
            "Stock",
        )
    )


def ledger_in_order(rows: DataFrame, grain: Sequence[str], period: Period) -> DataFrame:
    """The intervals of :func:`ledger` without netting, in one window over rows as they are.

    The running Stock takes in all rows of a date (a RANGE frame), and only a date's last row, whose
    successor has another date, sets an interval. So nothing but the window's own order is asked for:
    over a table bucketed by the grain and sorted by (grain, Date) there is no shuffle and no sort.
    Use it where the rows of a key are bounded, as in a table summed per (finer key, day).
    """
    start, end = period.start_lit, period.end_lit
    by_date = _by_date(grain)
    state = rows.where(F.col("Date") <= end).select(
        *grain,
        "Date",
        F.sum("Quantity").over(by_date.rangeBetween(Window.unboundedPreceding, Window.currentRow)).cast("long").alias("Stock"),
        F.lead("Date").over(by_date).alias("_next"),
    )
    last = F.col("_next").isNull() | ((F.col("_next") > F.col("Date")) & (F.col("_next") > start))
    return state.where(last & (F.col("Stock") > 0)).select(
        *grain,
        F.greatest(F.col("Date"), start).alias("StartDate"),
        F.coalesce(F.date_sub("_next", 1), end).alias("EndDate"),
        "Stock",
    )


def densify_daily(intervals: DataFrame, grain: Sequence[str], partitions: int | None = None) -> DataFrame:
    """C14: one row per day of each interval (``daily_stock``).

    A narrow ``explode`` of a date ``sequence``; intervals with StartDate > EndDate are dropped
    first (``sequence`` would count backwards). ``partitions`` spreads the intervals over that
    many tasks by key before exploding, so the output per task stays bounded; a key yields at
    most one row per day of the period, so hashing by key cannot create a hot task. The
    intervals (far fewer rows than the output) are then sorted by key and start inside each
    task, so the daily rows come out clustered by (key, Date): Parquet min/max statistics then
    let readers that filter on the key skip row groups, at no measurable write cost.
    """
    iv = intervals.where(F.col("StartDate") <= F.col("EndDate"))
    if partitions is not None:
        iv = iv.repartition(partitions, *grain).sortWithinPartitions(*grain, "StartDate")
    return iv.select(*grain, F.explode(F.sequence("StartDate", "EndDate")).alias("Date"), "Stock")


def densify_by_year(intervals: DataFrame, grain: Sequence[str], partitions: int, folders: Sequence[str] = ("Year",)) -> DataFrame:
    """C14 with a Year column, for a table in folders ``Year=...``.

    Intervals are cut at year ends and range-partitioned by (Year, key) before they are exploded, so a
    task holds a year or two: about ``partitions`` files over all years, and no sort of the daily rows.
    ``folders`` are the table's folder columns, outermost first: Year, columns of the grain, and Quarter (1 to 4), with
    which intervals are cut at quarter ends.
    """
    iv = intervals.where(F.col("StartDate") <= F.col("EndDate"))
    if "Quarter" in folders:
        quarters = F.explode(F.sequence(F.trunc("StartDate", "quarter"), "EndDate", F.expr("INTERVAL 3 MONTH"))).alias("_from")
        cut = iv.select(*grain, "StartDate", "EndDate", "Stock", quarters).select(
            *grain,
            F.greatest("StartDate", "_from").alias("StartDate"),
            F.least("EndDate", F.date_sub(F.add_months("_from", 3), 1)).alias("EndDate"),
            "Stock",
            F.year("_from").alias("Year"),
            F.quarter("_from").alias("Quarter"),
        )
    else:
        years = F.explode(F.sequence(F.year("StartDate"), F.year("EndDate"))).alias("Year")
        cut = iv.select(*grain, "StartDate", "EndDate", "Stock", years).select(
            *grain,
            F.greatest("StartDate", F.make_date("Year", F.lit(1), F.lit(1))).alias("StartDate"),
            F.least("EndDate", F.make_date("Year", F.lit(12), F.lit(31))).alias("EndDate"),
            "Stock",
            "Year",
        )
    order = [*folders, *(c for c in grain if c not in folders), "StartDate"]
    cut = cut.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    added = [c for c in folders if c not in grain]
    return cut.select(*grain, F.explode(F.sequence("StartDate", "EndDate")).alias("Date"), "Stock", *added)
