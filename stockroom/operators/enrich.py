"""Attach product attributes to facts (C3) and restrict facts to the period.

The product dimension is joined to every fact table. It is broadcast only after its size
has been measured (row count times an upper bound of the row width); above the bound the
join is left to a shuffle join, where AQE can still switch to broadcast at run time and
split skewed ProductId partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.config import DEFAULT_BROADCAST_MAX_BYTES, Period
from stockroom.operators.keyfilter import may_contain

# Types whose value fits the 8-byte slot every field takes in Spark's binary row format
# (decimals up to 18 digits; wider ones add 16 bytes, counted below).
_SLOT_TYPES = (
    T.BooleanType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.DateType,
    T.FloatType,
    T.LongType,
    T.DoubleType,
    T.TimestampType,
    T.TimestampNTZType,
    T.DecimalType,
)


def _round8(n: int) -> int:
    return (n + 7) // 8 * 8


def measured_size_bytes(df: DataFrame, unique_key: str | None = None) -> int:
    """Upper bound of the in-memory size of ``df``: rows x (null-bit header + one 8-byte slot per
    field + the longest value of each string column, 8-byte aligned). One small aggregate job.

    With ``unique_key`` the same aggregate raises if two rows share that key."""
    string_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    rows = F.count(F.lit(1))
    if unique_key:
        spare = rows - F.count_distinct(unique_key)
        message = F.concat(spare.cast("string"), F.lit(f" rows repeat the {unique_key} of another row; facts joined to it would count several times"))
        rows = F.when(spare == 0, rows).otherwise(F.raise_error(message).cast("long"))
    aggs = [rows.alias("rows")]
    aggs += [F.coalesce(F.max(F.octet_length(c)), F.lit(0)).alias(f"len_{i}") for i, c in enumerate(string_cols)]
    extra = 0
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType) and f.dataType.precision > 18:
            extra += 16
        elif not isinstance(f.dataType, (*_SLOT_TYPES, T.StringType)):
            raise TypeError(f"no width bound for column {f.name}: {f.dataType.simpleString()}")
    row = df.agg(*aggs).first()
    n_fields = len(df.schema.fields)
    per_row = 8 + 8 * n_fields + extra + sum(_round8(row[f"len_{i}"]) for i in range(len(string_cols)))
    return int(row["rows"]) * per_row


def sized_broadcast(df: DataFrame, max_bytes: int | None = DEFAULT_BROADCAST_MAX_BYTES, unique_key: str | None = None) -> DataFrame:
    """``broadcast(df)`` when its measured size is at most ``max_bytes``, else ``df`` unchanged; raises if
    rows share ``unique_key``."""
    if max_bytes is None and unique_key is None:
        return df
    size = measured_size_bytes(df, unique_key) if unique_key else measured_size_bytes(df)
    return F.broadcast(df) if max_bytes is not None and size <= max_bytes else df


def product_dimension(
    products: DataFrame, cols: Sequence[str], broadcast_max_bytes: int | None = DEFAULT_BROADCAST_MAX_BYTES
) -> DataFrame:
    """The narrow slice of the (clean) product table a join needs, broadcast when small enough."""
    return sized_broadcast(products.select("ProductId", *cols), broadcast_max_bytes)


def enrich(
    fact: DataFrame,
    products: DataFrame,
    cols: Sequence[str],
    broadcast_max_bytes: int | None = DEFAULT_BROADCAST_MAX_BYTES,
) -> DataFrame:
    """Inner join of a fact table to product attributes ``cols``; unknown products drop out.

    ``products`` must be the clean dimension: a product removed by cleaning disappears from
    every fact, the stock ledger included.
    """
    return fact.join(product_dimension(products, cols, broadcast_max_bytes), "ProductId", "inner")


def enrich_filtered(fact: DataFrame, products: DataFrame, cols: Sequence[str], bits: int | None = None) -> DataFrame:
    """C3 above the broadcast bound: as ``enrich``, with a Bloom filter of the clean ProductIds before the shuffle, so
    that facts of unknown products are not shuffled. ``bits`` is the filter's size; without it products are counted."""
    known = fact.where(may_contain(fact, products, "ProductId", bits))
    return known.join(products.select("ProductId", *cols), "ProductId", "inner")


def enrich_marked(
    fact: DataFrame,
    products: DataFrame,
    cols: Sequence[str],
    broadcast_max_bytes: int | None = DEFAULT_BROADCAST_MAX_BYTES,
) -> DataFrame:
    """C3 and C4 in one join: every fact, with NULL attributes where its product is unknown. The attributes of the
    clean dimension are never NULL, so ``cols[0]`` tells the two apart."""
    return fact.join(product_dimension(products, cols, broadcast_max_bytes), "ProductId", "left")


def unmatched(
    fact: DataFrame, products: DataFrame, broadcast_max_bytes: int | None = DEFAULT_BROADCAST_MAX_BYTES
) -> DataFrame:
    """C4: facts whose ProductId is not in the clean product dimension."""
    return fact.join(product_dimension(products, [], broadcast_max_bytes), "ProductId", "left_anti")


def period_filter(fact: DataFrame, period: Period, positive: bool = True) -> DataFrame:
    """Rows dated inside the period; with ``positive``, only Quantity > 0 (returns and
    outbound movements are ignored, not netted). Both predicates reach the Parquet scan."""
    cond = period.contains("Date")
    if positive:
        cond = cond & (F.col("Quantity") > 0)
    return fact.where(cond)
