"""Input conformance and the output contract check."""

from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stockroom import schemas
from stockroom.sources.parquet import dates_to_timestamps


def test_conform_selects_and_casts_in_contract_order(spark):
    raw = spark.createDataFrame(
        [(5.0, 7, "2019-01-02", 3.0, "extra")], "Quantity double, StoreId long, Date string, ProductId double, x string"
    )
    got = schemas.conform(raw, schemas.SALES)
    assert [f.name for f in got.schema.fields] == ["StoreId", "ProductId", "Date", "Quantity"]
    assert [f.dataType.simpleString() for f in got.schema.fields] == ["int", "int", "date", "bigint"]
    assert tuple(got.first()) == (7, 3, datetime.date(2019, 1, 2), 5)


def test_conform_keeps_wide_prices_and_refuses_to_cut(spark):
    products = "ProductRootCode long, ProductId int, SupplierPrice double, RetailPrice decimal(12,4), Family string"
    got = schemas.conform(spark.createDataFrame([(1, 2, 16777217.01, Decimal("0.1250"), "a")], products), schemas.PRODUCTS)
    assert [f.dataType.simpleString() for f in got.schema.fields] == ["int", "int", "double", "decimal(12,4)", "string"]
    assert (got.first()["SupplierPrice"], got.first()["RetailPrice"]) == (16777217.01, Decimal("0.1250"))
    sales = "StoreId long, ProductId int, Date date, Quantity double"
    day = datetime.date(2019, 1, 2)
    for row in ((1, 2, day, 1.9), (1, 2, day, float("inf")), (1 << 40, 2, day, 1.0)):
        with pytest.raises(PySparkException, match="is no"):
            schemas.conform(spark.createDataFrame([row], sales), schemas.SALES).collect()
    empty = schemas.conform(spark.createDataFrame([(None, 2, day, float("nan"))], sales), schemas.SALES).first()
    assert empty["StoreId"] is None and empty["Quantity"] is None


def test_conform_reports_missing_columns(spark):
    with pytest.raises(ValueError, match="missing columns"):
        schemas.conform(spark.createDataFrame([(1,)], "StoreId int"), schemas.SALES)


def test_contract_check_catches_type_and_nullability(spark):
    ok = spark.createDataFrame([], schemas.STORE_BENEFITS)
    assert schemas.schema_mismatches(ok, schemas.STORE_BENEFITS) == []
    nullable_profit = spark.createDataFrame([], "Year int, StoreId int, Profit double")
    assert schemas.schema_mismatches(nullable_profit, schemas.STORE_BENEFITS) == ["Profit: nullable, contract says not null"]
    assert schemas.schema_mismatches(nullable_profit, schemas.STORE_BENEFITS, check_nullability=False) == []
    wrong_type = spark.createDataFrame([], "Year int, StoreId long, Profit double")
    assert any("StoreId" in p for p in schemas.schema_mismatches(wrong_type, schemas.STORE_BENEFITS, False))


def test_dates_become_timestamps_keeping_nullability(spark):
    daily = spark.range(1).select(
        F.lit(1).alias("ProductRootCode"),
        F.lit(2).alias("StoreId"),
        F.explode(F.sequence(F.lit("2019-01-01").cast("date"), F.lit("2019-01-03").cast("date"))).alias("Date"),
        F.lit(5).cast("long").alias("Stock"),
    )
    out = dates_to_timestamps(daily)
    assert schemas.schema_mismatches(out, schemas.DAILY_STOCK) == []
    assert out.count() == 3
