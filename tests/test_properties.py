"""Invariants and equivalences on the sf0.001 fixtures.

* intervals of a key never overlap, StartDate <= EndDate, Stock > 0, all inside the period
* sum of Quantity is conserved (C27); interval days equal daily rows (C28)
* fused ledger == step-by-step ledger; year-overlap stock-days == per-day explosion
* fused KPI summary == separate KPI operators
* results do not depend on input partitioning or on the session time zone
"""

from __future__ import annotations

import pytest
from conftest import SF_SMALL, collect_sorted
from pyspark.sql import Window
from pyspark.sql import functions as F

from stockroom.config import FAMILY_GRAIN, FIXTURE_PERIOD, ROOT_GRAIN
from stockroom.operators import (
    active_timeline,
    average_stock,
    benefits_from_summary,
    change_intervals,
    clean,
    compare_grains,
    densify_daily,
    enrich,
    inbound_cost,
    kpi_facts,
    kpi_summary,
    ledger,
    net_movements,
    period_filter,
    positive_intervals,
    profit,
    reconcile_days,
    reconcile_quantity,
    revenue,
    rotation_from_summary,
    running_stock,
    stock_days,
    stock_timeline,
    turnover,
    units_sold,
)
from stockroom.plans.pipeline import movement_cube
from stockroom.sources import derive_inputs

P = FIXTURE_PERIOD


@pytest.fixture(scope="module")
def inputs(spark):
    raw = derive_inputs(spark, SF_SMALL)
    return clean(raw.products), clean(raw.sales), clean(raw.stock_movements)


def _mov(inputs, grain, movements=None):
    products, _, m = inputs
    return enrich(movements if movements is not None else m, products, [grain[0]])


@pytest.mark.parametrize("grain", [ROOT_GRAIN, FAMILY_GRAIN])
def test_intervals_are_disjoint_positive_and_inside_the_period(spark, inputs, grain):
    iv = ledger(_mov(inputs, grain), grain, P)
    w = Window.partitionBy(*grain).orderBy("StartDate")
    bad = iv.select(
        "*", F.lag("EndDate").over(w).alias("prev_end")
    ).where(
        (F.col("StartDate") > F.col("EndDate"))
        | (F.col("Stock") <= 0)
        | (F.col("StartDate") < F.lit(P.start))
        | (F.col("EndDate") > F.lit(P.end))
        | (F.col("prev_end") >= F.col("StartDate"))
    )
    assert bad.count() == 0
    assert iv.count() > 0


@pytest.mark.parametrize("grain", [ROOT_GRAIN, FAMILY_GRAIN])
def test_fused_ledger_equals_steps(spark, inputs, grain):
    mov = _mov(inputs, grain)
    timeline = stock_timeline(running_stock(net_movements(mov, grain), grain), grain, P.start)
    steps = positive_intervals(change_intervals(active_timeline(timeline, grain, P.start), grain, P.end))
    assert collect_sorted(ledger(mov, grain, P)) == collect_sorted(steps.select(*ledger(mov, grain, P).columns))


def test_quantity_is_conserved(spark, inputs):
    root, fam = _mov(inputs, ROOT_GRAIN), _mov(inputs, FAMILY_GRAIN)
    row = reconcile_quantity(root, net_movements(root, ROOT_GRAIN), fam, net_movements(fam, FAMILY_GRAIN)).first()
    assert row.Balanced and row.NetRoot != 0


def test_interval_days_equal_daily_rows(spark, inputs):
    iv = ledger(_mov(inputs, ROOT_GRAIN), ROOT_GRAIN, P)
    row = reconcile_days(iv, densify_daily(iv, ROOT_GRAIN)).first()
    assert row.Balanced and row.DailyRows == 171_462


@pytest.mark.parametrize("by", ["StoreId", "Family"])
def test_stock_days_by_year_overlap_equals_day_explosion(spark, inputs, by):
    iv = ledger(_mov(inputs, FAMILY_GRAIN), FAMILY_GRAIN, P)
    exploded = (
        densify_daily(iv, FAMILY_GRAIN)
        .groupBy(F.year("Date").alias("Year"), by)
        .agg(F.sum("Stock").alias("SumStock"))
    )
    assert collect_sorted(stock_days(iv, by)) == collect_sorted(exploded)
    assert collect_sorted(stock_days(densify_daily(iv, FAMILY_GRAIN), by)) == collect_sorted(exploded)


def test_compare_grains_takes_intervals_or_daily(spark, inputs):
    root = ledger(_mov(inputs, ROOT_GRAIN), ROOT_GRAIN, P)
    fam = ledger(_mov(inputs, FAMILY_GRAIN), FAMILY_GRAIN, P)
    a = compare_grains(root, fam).first()
    b = compare_grains(densify_daily(root, ROOT_GRAIN), densify_daily(fam, FAMILY_GRAIN)).first()
    assert a == b and a.Differ


def test_fused_kpis_equal_operators(spark, inputs):
    products, sales, movements = inputs
    sales_e = enrich(period_filter(sales, P), products, ["Family", "RetailPrice"])
    inbound_e = enrich(period_filter(movements, P), products, ["Family", "SupplierPrice"])
    fam_iv = ledger(enrich(movements, products, ["Family"]), FAMILY_GRAIN, P)
    cube = movement_cube(movements, products, P)
    cube_iv = ledger(cube.select(*FAMILY_GRAIN, "Date", "Quantity"), FAMILY_GRAIN, P)
    from_rows = kpi_summary(kpi_facts(sales_e, inbound_e, fam_iv))
    from_cube = kpi_summary(kpi_facts(sales_e, cube.where(P.contains("Date") & (cube.InboundRows > 0)), cube_iv))
    for by in ("StoreId", "Family"):
        ops_b = profit(revenue(sales_e, by), inbound_cost(inbound_e, by), by)
        ops_r = turnover(units_sold(sales_e, by), average_stock(stock_days(fam_iv, by), by), by)
        for summary in (from_rows, from_cube):
            assert collect_sorted(benefits_from_summary(summary, by)) == collect_sorted(ops_b)
            assert collect_sorted(rotation_from_summary(summary, by), ["Year", by, "Turnover"]) == collect_sorted(
                ops_r, ["Year", by, "Turnover"]
            )


def test_cube_ledger_equals_row_ledger(spark, inputs):
    products, _, movements = inputs
    cube = movement_cube(movements, products, P)
    for grain in (ROOT_GRAIN, FAMILY_GRAIN):
        want = collect_sorted(ledger(_mov(inputs, grain), grain, P))
        for colocate in (False, True):
            a = ledger(cube.select(*grain, "Date", "Quantity"), grain, P, colocate=colocate)
            assert collect_sorted(a) == want


def test_repartitioned_input_gives_same_intervals(spark, inputs):
    products, _, movements = inputs
    base = collect_sorted(ledger(_mov(inputs, ROOT_GRAIN), ROOT_GRAIN, P))
    shuffled = movements.repartition(13).sortWithinPartitions(F.col("Quantity").desc())
    assert collect_sorted(ledger(_mov(inputs, ROOT_GRAIN, shuffled), ROOT_GRAIN, P)) == base


@pytest.mark.parametrize("zone", ["UTC", "America/Asuncion", "Pacific/Kiritimati"])
def test_session_time_zone_does_not_matter(spark, inputs, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    base = collect_sorted(densify_daily(ledger(_mov(inputs, FAMILY_GRAIN), FAMILY_GRAIN, P), FAMILY_GRAIN))
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        other = collect_sorted(densify_daily(ledger(_mov(inputs, FAMILY_GRAIN), FAMILY_GRAIN, P), FAMILY_GRAIN))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert other == base
