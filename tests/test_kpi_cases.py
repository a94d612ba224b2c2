"""Hand-made KPI cases, through the separate operators and through the fused summary."""

from __future__ import annotations

from decimal import Decimal

import pytest
from conftest import make_facts, make_products
from pyspark.errors import PySparkException

from stockroom import schemas
from stockroom.config import BUSINESS_PERIOD as P
from stockroom.config import FAMILY_GRAIN
from stockroom.functions.money import price_scale_of
from stockroom.operators import (
    average_stock,
    benefits_from_summary,
    clean,
    duplicate_products,
    enrich,
    inbound_cost,
    kpi_facts,
    kpi_summary,
    ledger,
    period_filter,
    profit,
    revenue,
    rotation_from_summary,
    stock_days,
    turnover,
    units_sold,
)
from stockroom.plans.pipeline import movement_cube

PRODUCTS = [(1, 10, 2.0, 10.0, "A"), (2, 20, 1.5, 4.0, "B")]


def kpis(spark, sales_rows, movement_rows, via):
    products = clean(make_products(spark, PRODUCTS))
    sales = clean(make_facts(spark, sales_rows, schemas.SALES))
    movements = clean(make_facts(spark, movement_rows))
    sales_e = enrich(period_filter(sales, P), products, ["Family", "RetailPrice"])
    if via == "operators":
        inb = enrich(period_filter(movements, P), products, ["Family", "SupplierPrice"])
        fam_iv = ledger(enrich(movements, products, ["Family"]), FAMILY_GRAIN, P)
        out = {}
        for by in ("StoreId", "Family"):
            out[f"benefits_{by}"] = profit(revenue(sales_e, by), inbound_cost(inb, by), by)
            out[f"rotation_{by}"] = turnover(units_sold(sales_e, by), average_stock(stock_days(fam_iv, by), by), by)
        return {k: {tuple(r)[:2]: tuple(r)[2] for r in v.collect()} for k, v in out.items()}
    cube = movement_cube(movements, products, P)
    fam_iv = ledger(cube.select(*FAMILY_GRAIN, "Date", "Quantity"), FAMILY_GRAIN, P)
    inbound = cube.where(P.contains("Date") & (cube.InboundRows > 0))
    summary = kpi_summary(kpi_facts(sales_e, inbound, fam_iv))
    out = {}
    for by in ("StoreId", "Family"):
        out[f"benefits_{by}"] = benefits_from_summary(summary, by)
        out[f"rotation_{by}"] = rotation_from_summary(summary, by)
    return {k: {tuple(r)[:2]: tuple(r)[2] for r in v.collect()} for k, v in out.items()}


VIA = ["operators", "summary"]


@pytest.mark.parametrize("via", VIA)
def test_returns_are_ignored(spark, via):
    r = kpis(spark, [(1, 10, "2019-03-01", 3), (1, 10, "2019-03-02", -1)], [], via)
    assert r["benefits_StoreId"] == {(2019, 1): 30.0}
    assert r["benefits_Family"] == {(2019, "A"): 30.0}


@pytest.mark.parametrize("via", VIA)
def test_no_sales_profit_is_minus_cost(spark, via):
    r = kpis(spark, [], [(1, 10, "2019-03-01", 4)], via)
    assert r["benefits_StoreId"] == {(2019, 1): -8.0}


@pytest.mark.parametrize("via", VIA)
def test_outbound_is_ignored_in_cost(spark, via):
    r = kpis(spark, [], [(1, 10, "2019-03-01", 4), (1, 10, "2019-03-01", -4)], via)
    assert r["benefits_StoreId"] == {(2019, 1): -8.0}


@pytest.mark.parametrize("via", VIA)
@pytest.mark.parametrize("day,qty,year", [("2020-12-31", 366, 2020), ("2019-12-31", 365, 2019)])
def test_average_stock_uses_calendar_days(spark, via, day, qty, year):
    # a sale of 1 unit in the same year: turnover = 1 / average = 1 / 1.0
    r = kpis(spark, [(1, 10, day, 1)], [(1, 10, day, qty)], via)
    assert r["rotation_StoreId"][(year, 1)] == 1.0


@pytest.mark.parametrize("via", VIA)
def test_sold_without_stock_is_null(spark, via):
    r = kpis(spark, [(1, 10, "2019-05-01", 5)], [], via)
    assert r["rotation_StoreId"] == {(2019, 1): None}


@pytest.mark.parametrize("via", VIA)
def test_stock_without_sales_is_zero(spark, via):
    r = kpis(spark, [], [(1, 10, "2019-01-01", 2)], via)
    assert r["rotation_StoreId"] == {(2019, 1): 0.0, (2020, 1): 0.0}
    assert r["rotation_Family"] == {(2019, "A"): 0.0, (2020, "A"): 0.0}


@pytest.mark.parametrize("via", VIA)
@pytest.mark.parametrize("day", ["2018-12-31", "2021-01-01"])
def test_outside_the_period_has_no_effect(spark, via, day):
    r = kpis(spark, [(1, 10, day, 5)], [(1, 20, "2019-06-01", 2)], via)
    assert r["benefits_StoreId"] == {(2019, 1): -3.0}
    assert (2019, "A") not in r["rotation_Family"]


@pytest.mark.parametrize("via", VIA)
def test_missing_family_side(spark, via):
    # family B only has inbound stock, family A only sells: each KPI table keeps both keys
    r = kpis(spark, [(1, 10, "2019-02-01", 1)], [(1, 20, "2019-02-01", 2)], via)
    assert r["benefits_Family"] == {(2019, "A"): 10.0, (2019, "B"): -3.0}
    assert r["rotation_Family"][(2019, "A")] is None
    assert r["rotation_Family"][(2019, "B")] == 0.0


def test_profit_not_null_in_schema(spark):
    products = clean(make_products(spark, PRODUCTS))
    sales = clean(make_facts(spark, [(1, 10, "2019-03-01", 3)], schemas.SALES))
    sales_e = enrich(period_filter(sales, P), products, ["Family", "RetailPrice"])
    movements = clean(make_facts(spark, [(1, 10, "2019-03-01", 3)]))
    inb = enrich(period_filter(movements, P), products, ["Family", "SupplierPrice"])
    out = profit(revenue(sales_e, "StoreId"), inbound_cost(inb, "StoreId"), "StoreId")
    assert not out.schema["Profit"].nullable


def _profit_at(spark, price_type, prices, quantities, scale=2):
    """Profit of one store that sells ``quantities`` at ``prices`` of the given type."""
    schema = f"ProductRootCode int, ProductId int, SupplierPrice {price_type}, RetailPrice {price_type}, Family string"
    rows = [(i, i, prices[0], p, "A") for i, p in enumerate(prices)]
    products = schemas.conform(spark.createDataFrame(rows, schema), schemas.PRODUCTS)
    sales = make_facts(spark, [(1, i, "2019-05-01", q) for i, q in enumerate(quantities)], schemas.SALES)
    cost = make_facts(spark, [(1, 0, "2019-05-01", -1)])
    sales_e = enrich(period_filter(sales, P), products, ["Family", "RetailPrice"])
    inbound = enrich(period_filter(cost, P), products, ["Family", "SupplierPrice"])
    row = profit(revenue(sales_e, "StoreId", scale), inbound_cost(inbound, "StoreId", scale), "StoreId").first()
    return row["Profit"]


def test_prices_are_never_rounded(spark):
    # 1,000 units each at 0.125 and 0.004: int x price gives 129.0
    with pytest.raises(PySparkException, match="no exact value with 2 decimals"):
        _profit_at(spark, "float", [0.125, 0.004], [1000, 1000])
    assert _profit_at(spark, "float", [0.125, 0.004], [1000, 1000], scale=3) == 129.0
    assert _profit_at(spark, "double", [1234567.89, 16777217.01], [1, 1]) == 18011784.90
    assert _profit_at(spark, "decimal(12,4)", [Decimal("0.1250"), Decimal("0.0041")], [1000, 1000], scale=4) == 129.1
    with pytest.raises(PySparkException, match="no exact value"):
        _profit_at(spark, "decimal(12,4)", [Decimal("0.1250"), Decimal("0.0041")], [1000, 1000], scale=3)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_prices_that_are_not_finite_raise(spark, kind):
    with pytest.raises(PySparkException, match="no exact value"):
        _profit_at(spark, kind, [10.0, float("inf")], [1, 1])


def test_the_scale_comes_from_decimal_prices(spark):
    frame = lambda kind: spark.createDataFrame([], f"SupplierPrice float, RetailPrice {kind}")
    assert [price_scale_of(frame(k)) for k in ("float", "decimal(10,1)", "decimal(12,4)")] == [2, 2, 4]


def test_duplicate_products_are_reported(spark):
    products = make_products(spark, [(1, 10, 1.0, 2.0, "A"), (1, 10, 1.0, 3.0, "B"), (2, 20, 1.0, 1.0, "A")])
    assert [tuple(r) for r in duplicate_products(products).collect()] == [(10, 2)]
