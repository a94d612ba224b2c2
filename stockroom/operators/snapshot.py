"""Balance snapshots (C6, C7): the stock of every key as of a day, so that a run starts there.

A snapshot is a table (grain, AsOf, Stock): the sum of all movements of a key dated on or before ``AsOf``, keys
whose stock is zero included (they have an opening balance too). As sums are additive, a snapshot and the later
movements together say all that the whole history says about days after it:

* ``since`` puts a snapshot's balances in front of the later movements as one row a key, dated ``AsOf``; the ledger, the
  running stock and the opening balances of any period that starts after ``AsOf`` are those of the whole history.
* ``advance`` makes the snapshot of a later day from an earlier one and the movements between, ``absorb`` adds movements that
  arrived late; both touch the given movements alone.

The date filters are on the movements' Date column, so they reach the Parquet scan and prune files or row groups.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.operators.ledger import net_movements, running_stock


def stock_snapshot(movements: DataFrame, grain: Sequence[str], as_of: dt.date) -> DataFrame:
    """(grain, AsOf, Stock) of every key with a movement on or before ``as_of``."""
    past = movements.where(F.col("Date") <= F.lit(as_of))
    return past.groupBy(*grain).agg(F.sum("Quantity").cast("long").alias("Stock")).select(*grain, F.lit(as_of).alias("AsOf"), "Stock")


def as_movements(snapshot: DataFrame, grain: Sequence[str]) -> DataFrame:
    """A snapshot's balances as movements dated ``AsOf``."""
    return snapshot.select(*grain, F.col("AsOf").alias("Date"), F.col("Stock").alias("Quantity"))


def since(snapshot: DataFrame, movements: DataFrame, grain: Sequence[str], as_of: dt.date) -> DataFrame:
    """(grain, Date, Quantity): the snapshot's balances and the movements dated after ``as_of``."""
    later = movements.where(F.col("Date") > F.lit(as_of)).select(*grain, "Date", F.col("Quantity").cast("long").alias("Quantity"))
    return as_movements(snapshot, grain).unionByName(later)


def running_since(snapshot: DataFrame, movements: DataFrame, grain: Sequence[str], as_of: dt.date) -> DataFrame:
    """C6 for the days after ``as_of``: the rows that :func:`running_stock` over the whole history has there."""
    return running_stock(net_movements(since(snapshot, movements, grain, as_of), grain), grain).where(F.col("Date") > F.lit(as_of))


def opening_since(snapshot: DataFrame, movements: DataFrame, grain: Sequence[str], as_of: dt.date, start: dt.date) -> DataFrame:
    """C7 from a snapshot on or before ``start``: its balances and the movements between, summed per key. No window."""
    if as_of > start:
        raise ValueError(f"a snapshot of {as_of} says nothing about {start}")
    between = since(snapshot, movements.where(F.col("Date") <= F.lit(start)), grain, as_of)
    return between.groupBy(*grain).agg(F.sum("Quantity").cast("long").alias("Stock")).select(*grain, F.lit(start).alias("Date"), "Stock")


def advance(snapshot: DataFrame, movements: DataFrame, grain: Sequence[str], as_of: dt.date, to: dt.date) -> DataFrame:
    """The snapshot of ``to`` from that of ``as_of`` and the movements after it."""
    if to < as_of:
        raise ValueError(f"{to} is before the snapshot of {as_of}")
    return stock_snapshot(since(snapshot, movements, grain, as_of), grain, to)


def late_movements(batch: DataFrame, as_of: dt.date) -> DataFrame:
    """The rows of a batch of new movements that a snapshot of ``as_of`` should have held."""
    return batch.where(F.col("Date") <= F.lit(as_of))


def absorb(snapshot: DataFrame, batch: DataFrame, grain: Sequence[str], as_of: dt.date) -> DataFrame:
    """The snapshot with the late rows of a batch: only their keys change, keys new to it are added."""
    late = late_movements(batch, as_of).select(*grain, F.lit(as_of).alias("Date"), F.col("Quantity").cast("long").alias("Quantity"))
    return stock_snapshot(as_movements(snapshot, grain).unionByName(late), grain, as_of)
