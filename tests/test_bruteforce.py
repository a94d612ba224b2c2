"""Random movement histories vs a plain-Python day-by-day simulation (hypothesis).

Each example holds many independent keys in one DataFrame, so one Spark job checks them all.
The simulation knows nothing of windows: the stock on a day is the sum of all movements up to
that day; a change point is any day with a movement inside the period, plus the period start
when the key has earlier history.
"""

from __future__ import annotations

import datetime as dt

from conftest import collect_sorted
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stockroom import schemas
from stockroom.config import ROOT_GRAIN, Period
from stockroom.operators import (
    active_timeline,
    change_intervals,
    densify_daily,
    ledger,
    net_movements,
    positive_intervals,
    running_stock,
    stock_timeline,
)

PERIOD = Period(dt.date(2019, 1, 10), dt.date(2019, 2, 20))
FIRST_DAY = dt.date(2018, 12, 20)  # history before the period
LAST_DAY = dt.date(2019, 3, 5)  # rows after the period
SPAN = (LAST_DAY - FIRST_DAY).days

movement = st.tuples(st.integers(0, SPAN), st.integers(-6, 6))
history = st.lists(movement, min_size=1, max_size=12)
histories = st.lists(history, min_size=1, max_size=40)


def simulate(moves: list[tuple[dt.date, int]]):
    """(intervals, daily rows) of one key by brute force."""
    days = sorted({d for d, _ in moves})

    def stock(day):
        return sum(q for d, q in moves if d <= day)

    points = ([PERIOD.start] if days[0] <= PERIOD.start else []) + [
        d for d in days if PERIOD.start < d <= PERIOD.end
    ]
    intervals = []
    for i, p in enumerate(points):
        end = points[i + 1] - dt.timedelta(days=1) if i + 1 < len(points) else PERIOD.end
        if stock(p) > 0:
            intervals.append((p, end, stock(p)))
    daily = []
    d = PERIOD.start
    while d <= PERIOD.end:
        if days[0] <= d and stock(d) > 0:
            daily.append((d, stock(d)))
        d += dt.timedelta(days=1)
    return intervals, daily


def _frame(spark, keyed):
    rows = [(1, key, FIRST_DAY + dt.timedelta(days=o), q) for key, moves in enumerate(keyed) for o, q in moves]
    df = spark.createDataFrame(rows, schemas.STOCK_MOVEMENTS).withColumnRenamed("ProductId", "ProductRootCode")
    return df


@settings(max_examples=12, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keyed=histories)
def test_ledger_and_daily_match_simulation(spark, keyed):
    mov = _frame(spark, keyed)
    want_iv, want_daily = [], []
    for key, moves in enumerate(keyed):
        dated = [(FIRST_DAY + dt.timedelta(days=o), q) for o, q in moves]
        iv, daily = simulate(dated)
        want_iv += [(key, 1, s, e, q) for s, e, q in iv]
        want_daily += [(key, 1, d, q) for d, q in daily]
    fused = ledger(mov, ROOT_GRAIN, PERIOD)
    assert collect_sorted(fused, ["ProductRootCode", "StoreId", "StartDate", "EndDate", "Stock"]) == sorted(want_iv)
    assert collect_sorted(densify_daily(fused, ROOT_GRAIN), ["ProductRootCode", "StoreId", "Date", "Stock"]) == sorted(
        want_daily
    )


@settings(max_examples=6, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keyed=histories)
def test_late_cut_and_no_pruning_change_nothing(spark, keyed):
    """Cutting rows after the period before netting = cutting after the flags (step form).
    S13: dropping the prunable keys does not change the positive intervals."""
    mov = _frame(spark, keyed)
    timeline = stock_timeline(running_stock(net_movements(mov, ROOT_GRAIN), ROOT_GRAIN), ROOT_GRAIN, PERIOD.start)
    pruned = positive_intervals(
        change_intervals(active_timeline(timeline, ROOT_GRAIN, PERIOD.start), ROOT_GRAIN, PERIOD.end)
    )
    unpruned = positive_intervals(change_intervals(timeline, ROOT_GRAIN, PERIOD.end))
    early = ledger(mov, ROOT_GRAIN, PERIOD)
    assert collect_sorted(pruned) == collect_sorted(unpruned) == collect_sorted(early.select(*pruned.columns))
