"""Bloom filter of a dimension's keys, for fact joins above the broadcast bound.

Where the product dimension is too large to broadcast, the join shuffles every fact, also those whose product was
removed by cleaning. ``may_contain`` drops nearly all of these in the scan's own stage: a bit array of fixed size is
summed from the dimension with ``bit_or``, handed to the facts as a scalar subquery and read by an ordinary
expression inside whole-stage codegen. The join still decides, so a false positive costs its shuffle and nothing
else, and no fact with a known product is lost.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: 8 bits a key and 3 hash functions: about 3 % false positives.
BITS_PER_KEY, HASHES = 8, 3
#: 8 MiB, the bound of what goes to the tasks. A dimension above 8 M keys gets more false positives.
MOST_BITS = 1 << 26


def filter_bits(keys: int, most: int = MOST_BITS) -> int:
    """The size of the filter of ``keys`` keys: a power of two from 64 to ``most``."""
    return min(most, max(64, 1 << (max(keys, 1) * BITS_PER_KEY - 1).bit_length()))


def _places(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits).cast("long")) for i in range(HASHES)]


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))


def _word(place: Column) -> Column:
    return F.shiftright(place, 6).cast("int")


def _hashed(df: DataFrame, key: str) -> Column:
    """The key as it is hashed: whole numbers of any width alike, as a join compares them."""
    return F.col(key).cast("long") if isinstance(df.schema[key].dataType, T.IntegralType) else F.col(key)


def filter_words(dim: DataFrame, key: str, bits: int) -> DataFrame:
    """One row, ``words``: the filter of the keys of ``dim`` as 64-bit words; null keys are in no filter."""
    place = F.explode(F.array(*_places(_hashed(dim, key), bits)))
    placed = dim.where(F.col(key).isNotNull()).select(place.alias("place"))
    rows = placed.select(_word(F.col("place")).alias("word"), _bit(F.col("place")).alias("bits"))
    empty = dim.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = rows.unionByName(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    in_order = F.sort_array(F.collect_list(F.struct("word", "bits")))
    return words.agg(F.transform(in_order, lambda w: w["bits"]).alias("words"))


def may_contain(fact: DataFrame, dim: DataFrame, key: str, bits: int | None = None) -> Column:
    """Whether the key of a row of ``fact`` may be one of ``dim``: true for all that are, false for nearly all that
    are not, and for null. Without ``bits`` the keys are counted to size the filter."""
    kinds = [df.schema[key].dataType for df in (fact, dim)]
    if kinds[0] != kinds[1] and not all(isinstance(k, T.IntegralType) for k in kinds):
        raise TypeError(f"{key} is {kinds[0].simpleString()} in the facts and {kinds[1].simpleString()} in the dimension")
    if bits is None:
        bits = filter_bits(dim.count())
    words = filter_words(dim, key, bits).scalar()
    held = [F.get(words, _word(p)).bitwiseAND(_bit(p)) != 0 for p in _places(_hashed(fact, key), bits)]
    return reduce(Column.__and__, held, F.col(key).isNotNull())
