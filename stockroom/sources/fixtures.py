"""Derivation of the three retail inputs from the TPC-H-like test tables.

The reference ships schemas but no data. The fixtures map ``part`` to products and
``lineitem`` to sales and stock movements, with deliberate nulls, orphans, returns,
all-negative stores and zero-start stores so every branch of the ledger is exercised.
The derivation is a plain projection of the source tables: every row of ``part`` is a product,
every row of ``lineitem`` a sale and a stock movement.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom import schemas
from stockroom.sources.parquet import Inputs

# Fixed values of the fixture definition (FIXTURES.md §2).
ORPHAN_MOD, ORPHAN_REM = 40, 11  # facts of these parts name a product that does not exist
PRICE_NULL_MOD, PRICE_NULL_REM = 50, 7  # products with a null RetailPrice
ROOT_SIZE = 4  # ProductRootCode = floor(partkey / 4)
SUPPLIER_PRICE_FACTOR = 0.5
NO_SALES_STORE_REM = 3  # stores whose id ends in 3 never sell, they only take returns
OUTBOUND_ONLY_STORE_REM = 4  # stores ending in 4 only lose stock
ZERO_START_STORE_REM = 5  # stores ending in 5 start at zero
ZERO_START_UNTIL = _dt.date(1999, 1, 1)
SALES_NULL_QTY_MOD = 997
MOVEMENT_NULL_DATE_MOD = 991


def derive_products(part: DataFrame) -> DataFrame:
    key = F.col("p_partkey")
    return schemas.conform(
        part.select(
            F.floor(key / ROOT_SIZE).cast("int").alias("ProductRootCode"),
            key.cast("int").alias("ProductId"),
            (F.col("p_retailprice") * SUPPLIER_PRICE_FACTOR).cast("float").alias("SupplierPrice"),
            F.when(key % PRICE_NULL_MOD == PRICE_NULL_REM, F.lit(None))
            .otherwise(F.col("p_retailprice"))
            .cast("float")
            .alias("RetailPrice"),
            F.col("p_type").alias("Family"),
        ),
        schemas.PRODUCTS,
    )


def _product_id() -> Column:
    key = F.col("l_partkey")
    # no part has a negative key
    return F.when(key % ORPHAN_MOD == ORPHAN_REM, -key).otherwise(key).cast("int").alias("ProductId")


def derive_sales(lineitem: DataFrame) -> DataFrame:
    qty = F.col("l_quantity")
    return schemas.conform(
        lineitem.select(
            F.col("l_suppkey").cast("int").alias("StoreId"),
            _product_id(),
            F.col("l_shipdate").cast("date").alias("Date"),
            F.when(F.col("l_orderkey") % SALES_NULL_QTY_MOD == 0, F.lit(None))
            .when((F.col("l_returnflag") == "R") | (F.col("l_suppkey") % 10 == NO_SALES_STORE_REM), -qty)
            .otherwise(qty)
            .cast("int")
            .alias("Quantity"),
        ),
        schemas.SALES,
    )


def derive_stock_movements(lineitem: DataFrame) -> DataFrame:
    qty = F.col("l_quantity")
    ship_day = F.col("l_shipdate").cast("date")  # source timestamps are always at midnight
    store_rem = F.col("l_suppkey") % 10
    return schemas.conform(
        lineitem.select(
            F.col("l_suppkey").cast("int").alias("StoreId"),
            _product_id(),
            F.when(F.col("l_orderkey") % MOVEMENT_NULL_DATE_MOD == 0, F.lit(None).cast("date"))
            .otherwise(ship_day)
            .alias("Date"),
            F.when(store_rem == OUTBOUND_ONLY_STORE_REM, -qty)
            .when((store_rem == ZERO_START_STORE_REM) & (ship_day <= F.lit(ZERO_START_UNTIL)), F.lit(0.0))
            .when(F.col("l_linestatus") == "F", qty)
            .otherwise(-qty)
            .cast("int")
            .alias("Quantity"),
        ),
        schemas.STOCK_MOVEMENTS,
    )


def derive_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    base = sf_dir.rstrip("/")
    part = spark.read.parquet(f"{base}/part.parquet")
    lineitem = spark.read.parquet(f"{base}/lineitem.parquet")
    return Inputs(
        products=derive_products(part),
        sales=derive_sales(lineitem),
        stock_movements=derive_stock_movements(lineitem),
    )


def write_inputs(spark: SparkSession, sf_dir: str, out_dir: str) -> None:
    """Materialise the three inputs as Parquet tables, the layout the pipeline reads."""
    inputs = derive_inputs(spark, sf_dir)
    base = out_dir.rstrip("/")
    inputs.products.write.mode("overwrite").parquet(f"{base}/products.parquet")
    inputs.sales.write.mode("overwrite").parquet(f"{base}/sales.parquet")
    inputs.stock_movements.write.mode("overwrite").parquet(f"{base}/stock_movements.parquet")
