"""Hand-made ledger cases (period 2019-01-01 .. 2020-12-31), fused and step-by-step forms."""

from __future__ import annotations

import pytest
from conftest import collect_sorted, d, make_facts, make_products

from stockroom import schemas
from stockroom.config import BUSINESS_PERIOD as P
from stockroom.config import FAMILY_GRAIN, ROOT_GRAIN
from stockroom.operators import (
    active_timeline,
    change_intervals,
    clean,
    densify_daily,
    enrich,
    ledger,
    net_movements,
    positive_intervals,
    prunable_keys,
    running_stock,
    stock_timeline,
)

PRODUCTS = [(1, 10, 2.0, 5.0, "A"), (1, 11, 2.0, 5.0, "B"), (2, 20, 1.0, None, "A")]

CASES = {
    "opening carried in": ([("2018-05-01", 5)], [("2019-01-01", "2020-12-31", 5)]),
    "movement on the start day joins the opening": (
        [("2018-05-01", 5), ("2019-01-01", -2)],
        [("2019-01-01", "2020-12-31", 3)],
    ),
    "no opening, late first movement": ([("2019-03-10", 4)], [("2019-03-10", "2020-12-31", 4)]),
    "same-day movements are netted": ([("2019-03-10", 4), ("2019-03-10", -1)], [("2019-03-10", "2020-12-31", 3)]),
    "dip to zero": (
        [("2018-05-01", 2), ("2019-02-01", -2), ("2019-04-01", 1)],
        [("2019-01-01", "2019-01-31", 2), ("2019-04-01", "2020-12-31", 1)],
    ),
    "dip below zero": (
        [("2018-05-01", 2), ("2019-02-01", -3), ("2019-04-01", 2)],
        [("2019-01-01", "2019-01-31", 2), ("2019-04-01", "2020-12-31", 1)],
    ),
    "change on the last day": (
        [("2019-01-05", 1), ("2020-12-31", 1)],
        [("2019-01-05", "2020-12-30", 1), ("2020-12-31", "2020-12-31", 2)],
    ),
    "change after the end is ignored": ([("2019-01-05", 1), ("2021-01-01", 9)], [("2019-01-05", "2020-12-31", 1)]),
    "unchanged net still splits": (
        [("2019-01-05", 1), ("2019-02-01", 3), ("2019-02-01", -3)],
        [("2019-01-05", "2019-01-31", 1), ("2019-02-01", "2020-12-31", 1)],
    ),
    "lone zero opening": ([("2018-01-01", 1), ("2018-02-01", -1)], []),
    "all negative": ([("2019-01-05", -1)], []),
    "several openings, only the last counts": (
        [("2017-01-01", 7), ("2018-01-01", -2), ("2018-12-31", 1)],
        [("2019-01-01", "2020-12-31", 6)],
    ),
}


def _root_movements(spark, moves):
    products = clean(make_products(spark, PRODUCTS))
    facts = make_facts(spark, [(1, 10, day, q) for day, q in moves])
    return enrich(clean(facts), products, ["ProductRootCode"])


def _steps(mov, grain):
    net = net_movements(mov, grain)
    timeline = stock_timeline(running_stock(net, grain), grain, P.start)
    return positive_intervals(change_intervals(active_timeline(timeline, grain, P.start), grain, P.end))


@pytest.mark.parametrize("case", sorted(CASES))
def test_ledger_case(spark, case):
    moves, expected = CASES[case]
    mov = _root_movements(spark, moves)
    want = [(1, 1, d(s), d(e), q) for s, e, q in expected]
    cols = ["ProductRootCode", "StoreId", "StartDate", "EndDate", "Stock"]
    assert collect_sorted(ledger(mov, ROOT_GRAIN, P), cols) == want
    assert collect_sorted(_steps(mov, ROOT_GRAIN), cols) == want


@pytest.mark.parametrize(
    "case,reason",
    [("lone zero opening", "lone_zero_opening"), ("all negative", "all_negative"), ("opening carried in", None)],
)
def test_audit_flags(spark, case, reason):
    mov = _root_movements(spark, CASES[case][0])
    timeline = stock_timeline(running_stock(net_movements(mov, ROOT_GRAIN), ROOT_GRAIN), ROOT_GRAIN, P.start)
    flagged = prunable_keys(timeline, ROOT_GRAIN, P.start).select("Reason").distinct().collect()
    assert [r.Reason for r in flagged] == ([reason] if reason else [])


def test_null_price_product_has_no_stock(spark):
    products = clean(make_products(spark, PRODUCTS))
    facts = make_facts(spark, [(1, 20, "2019-05-01", 3)])
    mov = enrich(clean(facts), products, ["ProductRootCode"])
    assert ledger(mov, ROOT_GRAIN, P).count() == 0


def test_two_families_under_one_root(spark):
    products = clean(make_products(spark, PRODUCTS))
    facts = clean(make_facts(spark, [(1, 10, "2019-05-01", 5), (1, 11, "2019-05-01", -3)]))
    root = ledger(enrich(facts, products, ["ProductRootCode"]), ROOT_GRAIN, P)
    fam = ledger(enrich(facts, products, ["Family"]), FAMILY_GRAIN, P)
    assert collect_sorted(root.select("Stock")) == [(2,)]
    assert collect_sorted(fam, ["Family", "Stock"]) == [("A", 5)]


def test_order_of_input_rows_does_not_matter(spark):
    """The successor of a change is the next change in date order, whatever the input order."""
    rows = [(1, 10, f"2019-{m:02d}-01", (-1) ** m * m) for m in range(12, 0, -1)]
    products = clean(make_products(spark, PRODUCTS))
    facts = clean(make_facts(spark, rows))
    base = collect_sorted(ledger(enrich(facts, products, ["ProductRootCode"]), ROOT_GRAIN, P))
    shuffled = facts.repartition(7).sortWithinPartitions("Quantity")
    assert collect_sorted(ledger(enrich(shuffled, products, ["ProductRootCode"]), ROOT_GRAIN, P)) == base


def test_intervals_schema(spark):
    mov = _root_movements(spark, CASES["dip to zero"][0])
    iv = ledger(mov, ROOT_GRAIN, P)
    types = {f.name: f.dataType.simpleString() for f in iv.schema.fields}
    assert types == {"ProductRootCode": "int", "StoreId": "int", "StartDate": "date", "EndDate": "date", "Stock": "bigint"}
    assert set(iv.columns) == {f.name for f in schemas.INTERVAL_STOCK.fields}


def test_nan_price_product_is_cleaned_away(spark):
    products = make_products(spark, [(1, 10, 2.0, float("nan"), "A"), (1, 11, 2.0, 5.0, "A")])
    clean_ids = sorted(r.ProductId for r in clean(products).collect())
    assert clean_ids == [11]
    facts = clean(make_facts(spark, [(1, 10, "2019-05-01", 3), (1, 11, "2019-05-01", 2)]))
    iv = ledger(enrich(facts, clean(products), ["ProductRootCode"]), ROOT_GRAIN, P)
    assert collect_sorted(iv.select("Stock")) == [(2,)]


def test_duplicate_product_id_fans_out(spark):
    """Like the plain join it replaces, a ProductId listed twice counts its movements twice."""
    products = clean(make_products(spark, [(1, 10, 2.0, 5.0, "A"), (1, 10, 2.0, 5.0, "A")]))
    facts = clean(make_facts(spark, [(1, 10, "2019-05-01", 3)]))
    iv = ledger(enrich(facts, products, ["ProductRootCode"]), ROOT_GRAIN, P)
    assert collect_sorted(iv.select("Stock")) == [(6,)]


def test_lone_zero_opening_at_family_grain(spark):
    products = clean(make_products(spark, PRODUCTS))
    # family A (product 10) goes +1 then -1 before the period; family B (product 11) owes 1.
    # Both products share root 1, whose stock is therefore negative on every row.
    facts = clean(
        make_facts(spark, [(1, 10, "2018-01-01", 1), (1, 10, "2018-02-01", -1), (1, 11, "2018-03-01", -1)])
    )
    fam = enrich(facts, products, ["Family"])
    timeline = stock_timeline(running_stock(net_movements(fam, FAMILY_GRAIN), FAMILY_GRAIN), FAMILY_GRAIN, P.start)
    reasons = {(r.Family, r.Reason) for r in prunable_keys(timeline, FAMILY_GRAIN, P.start).collect()}
    assert reasons == {("A", "lone_zero_opening"), ("B", "all_negative")}
    root = enrich(facts, products, ["ProductRootCode"])
    timeline = stock_timeline(running_stock(net_movements(root, ROOT_GRAIN), ROOT_GRAIN), ROOT_GRAIN, P.start)
    assert [r.Reason for r in prunable_keys(timeline, ROOT_GRAIN, P.start).collect()] == ["all_negative"]
    assert ledger(fam, FAMILY_GRAIN, P).count() == 0


def test_flags_are_computed_before_the_end_cut(spark):
    """A zero opening followed by a change after the period end is not a lone zero opening."""
    mov = _root_movements(spark, [("2018-01-01", 1), ("2018-02-01", -1), ("2021-03-01", 5)])
    timeline = stock_timeline(running_stock(net_movements(mov, ROOT_GRAIN), ROOT_GRAIN), ROOT_GRAIN, P.start)
    assert prunable_keys(timeline, ROOT_GRAIN, P.start).count() == 0
    assert ledger(mov, ROOT_GRAIN, P).count() == 0


def test_reversed_interval_is_not_exploded_backwards(spark):
    """``sequence`` would count down from StartDate to an earlier EndDate; such rows are dropped."""
    iv = spark.createDataFrame(
        [(1, 1, d("2019-01-05"), d("2019-01-03"), 4), (1, 2, d("2019-01-03"), d("2019-01-04"), 2)],
        "ProductRootCode int, StoreId int, StartDate date, EndDate date, Stock long",
    )
    daily = densify_daily(iv, ROOT_GRAIN)
    assert collect_sorted(daily, ["StoreId", "Date"]) == [(2, d("2019-01-03")), (2, d("2019-01-04"))]
