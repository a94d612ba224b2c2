"""Yearly KPIs (C16-C23): profit and stock turnover, by store and by family.

Profit   = sum(UnitsSold x RetailPrice) - sum(Inbounds x SupplierPrice)
Turnover = UnitsSold / AverageStock, AverageStock = sum of daily positive stock / days of the year

Each step is available as its own operator. :func:`kpi_summary` computes all four KPI tables
in one aggregation: the sales, inbound and stock-day facts are tagged, unioned, and
aggregated with GROUPING SETS ((Year, StoreId), (Year, Family)). Partial aggregation runs in
the map tasks, so only a few rows per (Year, key) and task cross the network, and the big
fact tables are scanned once for both grains and both KPIs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroom.config import DEFAULT_PRICE_SCALE
from stockroom.functions.dates import days_in_year, overlap_days, year_first_day, year_last_day
from stockroom.functions.money import money_to_double, price_units, units_to_decimal, units_to_double

UNITS_SUFFIX = "Units"


def _year() -> Column:
    return F.year("Date").alias("Year")


def with_price_units(products: DataFrame, price_scale: int = DEFAULT_PRICE_SCALE) -> DataFrame:
    """Add RetailPriceUnits and SupplierPriceUnits: exact prices in LONG minor units.

    Computed once per product on the dimension, so fact rows joined to it only do LONG math.
    """
    return products.withColumns(
        {
            "RetailPrice" + UNITS_SUFFIX: price_units(products, "RetailPrice", price_scale),
            "SupplierPrice" + UNITS_SUFFIX: price_units(products, "SupplierPrice", price_scale),
        }
    )


def line_amount(df: DataFrame, price: str, price_scale: int = DEFAULT_PRICE_SCALE) -> Column:
    """Quantity x price in exact LONG minor units; uses the precomputed ``<price>Units`` column
    when the frame carries it, else converts ``price`` row by row."""
    pre = price + UNITS_SUFFIX
    unit = F.col(pre) if pre in df.columns else price_units(df, price, price_scale)
    return F.col("Quantity").cast("long") * unit


def revenue(sales: DataFrame, by: str, price_scale: int = DEFAULT_PRICE_SCALE) -> DataFrame:
    """sum(Quantity x RetailPrice) per (Year, by); ``sales`` are enriched, in-period, positive.
    Revenue is an exact DECIMAL(38, price_scale)."""
    return (
        sales.groupBy(_year(), by)
        .agg(F.sum(line_amount(sales, "RetailPrice", price_scale)).alias("_units"))
        .select("Year", by, units_to_decimal("_units", price_scale).alias("Revenue"))
    )


def inbound_cost(movements: DataFrame, by: str, price_scale: int = DEFAULT_PRICE_SCALE) -> DataFrame:
    """C17: sum(Quantity x SupplierPrice) per (Year, by) over enriched, in-period, inbound movements
    (exact DECIMAL)."""
    return (
        movements.groupBy(_year(), by)
        .agg(F.sum(line_amount(movements, "SupplierPrice", price_scale)).alias("_units"))
        .select("Year", by, units_to_decimal("_units", price_scale).alias("Cost"))
    )


def _profit(rev: Column, cost: Column) -> Column:
    return money_to_double(F.coalesce(rev, F.lit(0)) - F.coalesce(cost, F.lit(0)))


def profit(rev: DataFrame, cost: DataFrame, by: str) -> DataFrame:
    """Full outer join of the two halves; a missing half counts as 0."""
    return rev.join(cost, ["Year", by], "full").select("Year", by, _profit(F.col("Revenue"), F.col("Cost")).alias("Profit"))


def units_sold(sales: DataFrame, by: str) -> DataFrame:
    """sum(Quantity) per (Year, by) over enriched, in-period, positive sales."""
    return sales.groupBy(_year(), by).agg(F.sum("Quantity").cast("long").alias("UnitsSold"))


def interval_years(intervals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Split each interval by calendar year: (Year, keys, Days inside the year, StockDays = Stock x Days).

    Equal to counting and summing the daily rows of the interval per year, without exploding
    the days: an interval yields one row per calendar year it touches.
    """
    years = F.explode(F.sequence(F.year("StartDate"), F.year("EndDate"))).alias("Year")
    per_year = intervals.select(*keys, "StartDate", "EndDate", "Stock", years)
    days = overlap_days("StartDate", "EndDate", year_first_day("Year"), year_last_day("Year"))
    return per_year.select("Year", *keys, days.alias("Days"), (F.col("Stock") * days).alias("StockDays"))


def stock_days(intervals_or_daily: DataFrame, by: str) -> DataFrame:
    """C20: sum of daily positive stock per (Year, by).

    From positive intervals (StartDate, EndDate) the days are never exploded: each interval is
    split at year boundaries and weighted by its days. A daily table (Date) is summed directly.
    """
    df = intervals_or_daily
    if "StartDate" not in df.columns:
        return df.groupBy(_year(), by).agg(F.sum("Stock").cast("long").alias("SumStock"))
    return interval_years(df, [by]).groupBy("Year", by).agg(F.sum("StockDays").cast("long").alias("SumStock"))


def _average(sum_stock: Column, year: Column) -> Column:
    return sum_stock / days_in_year(year)


def average_stock(stock_days_df: DataFrame, by: str) -> DataFrame:
    """AverageStock = SumStock / calendar days of the year (days without stock count as 0)."""
    return stock_days_df.select("Year", by, _average(F.col("SumStock"), F.col("Year")).alias("AverageStock"))


def _turnover(units: Column, avg: Column) -> Column:
    # A missing average is 0 and a division by 0 is NULL (no stock: turnover undefined).
    return F.try_divide(F.coalesce(units, F.lit(0)), F.coalesce(avg, F.lit(0.0)))


def turnover(units: DataFrame, avg: DataFrame, by: str) -> DataFrame:
    """Full outer join of UnitsSold and AverageStock; Turnover is NULL without stock, 0.0 without sales."""
    return units.join(avg, ["Year", by], "full").select(
        "Year", by, _turnover(F.col("UnitsSold"), F.col("AverageStock")).alias("Turnover")
    )


# ---------------------------------------------------------------------------------------
# All four KPI tables in one aggregation
# ---------------------------------------------------------------------------------------

STOCK_MEASURES = ("StockDays", "StockRows")
_SUMMARY_MEASURES = ("RevenueUnits", "CostUnits", "UnitsSold", "StockDays", "SalesRows", "CostRows", "StockRows")


def _facts(df: DataFrame, **measures: Column) -> DataFrame:
    cols = [F.col("Year"), F.col("StoreId"), F.col("Family")]
    for m in _SUMMARY_MEASURES:
        cols.append((measures[m] if m in measures else F.lit(None).cast("long")).alias(m))
    return df.select(*cols)


def kpi_facts(
    sales: DataFrame,
    inbound: DataFrame,
    family_intervals: DataFrame,
    price_scale: int = DEFAULT_PRICE_SCALE,
) -> DataFrame:
    """The tagged union feeding :func:`kpi_summary`.

    * ``sales``: enriched (Family and RetailPrice or RetailPriceUnits), in-period, positive sales.
    * ``inbound``: enriched (Family and SupplierPrice or SupplierPriceUnits) in-period inbound
      movements, or pre-aggregated rows carrying ``InboundCostUnits`` and ``InboundRows``
      (the movement cube).
    * ``family_intervals``: positive intervals of the (Family, StoreId) ledger.

    Money measures are exact LONG minor units of ``price_scale``.
    """
    return sales_facts(sales, price_scale).unionByName(inbound_facts(inbound, price_scale)).unionByName(stock_facts(family_intervals))


def sales_facts(sales: DataFrame, price_scale: int = DEFAULT_PRICE_SCALE) -> DataFrame:
    return _facts(
        sales.select(
            _year(),
            "StoreId",
            "Family",
            F.col("Quantity").cast("long").alias("_qty"),
            line_amount(sales, "RetailPrice", price_scale).alias("_amount"),
        ),
        RevenueUnits=F.col("_amount"),
        UnitsSold=F.col("_qty"),
        SalesRows=F.lit(1).cast("long"),
    )


def inbound_facts(inbound: DataFrame, price_scale: int = DEFAULT_PRICE_SCALE) -> DataFrame:
    if "InboundCostUnits" in inbound.columns:
        return _facts(
            inbound.select(_year(), "StoreId", "Family", "InboundCostUnits", "InboundRows"),
            CostUnits=F.col("InboundCostUnits"),
            CostRows=F.col("InboundRows").cast("long"),
        )
    return _facts(
        inbound.select(_year(), "StoreId", "Family", line_amount(inbound, "SupplierPrice", price_scale).alias("_amount")),
        CostUnits=F.col("_amount"),
        CostRows=F.lit(1).cast("long"),
    )


def stock_facts(family_intervals: DataFrame) -> DataFrame:
    return _facts(
        interval_years(family_intervals, ["StoreId", "Family"]),
        StockDays=F.col("StockDays").cast("long"),
        StockRows=F.col("Days").cast("long"),  # (key, day) rows with positive stock
    )


def fact_sums(facts: DataFrame) -> DataFrame:
    """The facts summed per (Year, StoreId, Family): a few rows for each store, which further facts can be added to."""
    return facts.groupBy("Year", "StoreId", "Family").agg(*[F.sum(m).alias(m) for m in _SUMMARY_MEASURES])


def kpi_summary(facts: DataFrame) -> DataFrame:
    """Sums per (Year, StoreId) and per (Year, Family) in one GROUPING SETS aggregate.

    ``Grain`` names the set a row belongs to ('StoreId' or 'Family'); the other key is NULL. The facts are
    first summed per (Year, StoreId, Family), so only that small result is expanded to both sets.
    """
    return summary_of_sums(fact_sums(facts))


def summary_of_sums(sums: DataFrame) -> DataFrame:
    """:func:`kpi_summary` from rows of :func:`fact_sums`."""
    grouped = sums.groupingSets([["Year", "StoreId"], ["Year", "Family"]], "Year", "StoreId", "Family").agg(
        F.sum("RevenueUnits").alias("RevenueUnits"),
        F.sum("CostUnits").alias("CostUnits"),
        F.sum("UnitsSold").alias("UnitsSold"),
        F.sum("StockDays").alias("SumStock"),
        F.sum("SalesRows").alias("SalesRows"),
        F.sum("CostRows").alias("CostRows"),
        F.sum("StockRows").alias("StockRows"),
        F.grouping("StoreId").alias("_no_store"),
    )
    return grouped.select(
        F.when(F.col("_no_store") == 1, F.lit("Family")).otherwise(F.lit("StoreId")).alias("Grain"),
        *[c for c in grouped.columns if c != "_no_store"],
    )


def benefits_from_summary(summary: DataFrame, by: str, price_scale: int = DEFAULT_PRICE_SCALE) -> DataFrame:
    """``store_benefits`` / ``family_benefits``: keys with sales or inbound movements."""
    rows = summary.where((F.col("Grain") == by) & ((F.col("SalesRows") > 0) | (F.col("CostRows") > 0)))
    net = F.coalesce(F.col("RevenueUnits"), F.lit(0)) - F.coalesce(F.col("CostUnits"), F.lit(0))
    return rows.select("Year", by, units_to_double(net, price_scale).alias("Profit"))


def rotation_from_summary(summary: DataFrame, by: str) -> DataFrame:
    """``store_rotation`` / ``family_rotation``: keys with sales or positive stock."""
    rows = summary.where((F.col("Grain") == by) & ((F.col("SalesRows") > 0) | (F.col("StockRows") > 0)))
    avg = _average(F.col("SumStock"), F.col("Year"))
    return rows.select("Year", by, _turnover(F.col("UnitsSold"), avg).alias("Turnover"))

