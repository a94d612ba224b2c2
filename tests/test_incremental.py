"""Batches added to a state: the result of a full run, from the partitions of the touched stores alone."""

from __future__ import annotations

import os
import shutil
import tempfile

import pytest
from conftest import SF_SMALL, collect_sorted, d, make_facts, make_products
from pyspark.sql import functions as F

from stockroom import schemas
from stockroom.config import FIXTURE_PERIOD, FIXTURE_PRICE_SCALE
from stockroom.operators import densify_daily
from stockroom.operators.ledger import densify_by_year
from stockroom.plans import pipeline, run_pipeline
from stockroom.plans.incremental import RetailState
from stockroom.sources import files, read_inputs, write_inputs
from stockroom.sources.parquet import Inputs

TABLES = ("interval_stock", "daily_stock", "store_benefits", "family_benefits", "store_rotation", "family_rotation")
STORE = 3


@pytest.fixture(scope="module")
def inputs(spark):
    path = tempfile.mkdtemp(prefix="stockroom-in-")
    write_inputs(spark, SF_SMALL, path)
    return read_inputs(spark, path)


_FULL, _STATES = {}, {}


def full(spark, inputs, name):
    """The tables of a full run, computed once for each name."""
    if name not in _FULL:
        _FULL[name] = _full(spark, inputs)
    return _FULL[name]


def _full(spark, inputs):
    out = tempfile.mkdtemp(prefix="stockroom-out-")
    run_pipeline(spark, out, inputs=inputs, period=FIXTURE_PERIOD, price_scale=FIXTURE_PRICE_SCALE, timestamp_output=False)
    return {n: rows_of(n, spark.read.parquet(f"{out}/{n}.parquet")) for n in TABLES}


def rows_of(name, df):
    """The rows, or the number and a sum of hashes of the many daily rows."""
    if name != "daily_stock":
        return collect_sorted(df)
    hashed = F.xxhash64("ProductRootCode", "StoreId", "Date", "Stock").cast("decimal(20,0)")
    return tuple(df.agg(F.count(F.lit(1)), F.sum(hashed)).first())


def published(state):
    return {n: rows_of(n, state.table(n)) for n in TABLES}


def is_new(store):
    """A batch: late and recent movements of one store, a few of its products."""
    return (F.col("StoreId") == store) & (F.col("ProductId") % 5 == 0) & ((F.col("Date") < "1998-06-01") | (F.col("Date") > "2000-03-01"))


def parts(inputs, new):
    rest = F.coalesce(~new, F.lit(True))
    first = Inputs(inputs.products, inputs.sales.where(rest), inputs.stock_movements.where(rest))
    return first, inputs.stock_movements.where(new), inputs.sales.where(new)


def file_times(folder, table):
    found = {}
    for top, _, names in os.walk(f"{folder}/{table}"):
        for name in names:
            if name.endswith(".parquet"):
                found[os.path.relpath(f"{top}/{name}", folder)] = os.stat(f"{top}/{name}").st_mtime_ns
    return found


def create(spark, inputs, name):
    """A state of its own, copied from one that was made once for each name."""
    if name not in _STATES:
        _STATES[name] = tempfile.mkdtemp(prefix="stockroom-state-") + "/s"
        RetailState.create(spark, _STATES[name], inputs, FIXTURE_PERIOD, FIXTURE_PRICE_SCALE)
    own = tempfile.mkdtemp(prefix="stockroom-state-") + "/s"
    shutil.copytree(_STATES[name], own)
    return RetailState.open(spark, own)


def test_a_batch_of_one_store_rewrites_that_store_and_equals_a_full_run(spark, inputs):
    first, movements, sales = parts(inputs, is_new(STORE))
    state = create(spark, first, "without")
    assert published(state) == full(spark, first, "without")
    before = {t: file_times(state.folder, t) for t in ("cube", "intervals", "daily", "facts")}
    applied = state.apply("b1", inputs.products, movements, sales)
    assert applied.stores == [STORE] and applied.first_year == 1999 and 0 < applied.keys
    assert published(state) == full(spark, inputs, "whole")
    for table, old in before.items():
        new = file_times(state.folder, table)
        same = {n for n in old if new.get(n) == old[n]}
        # all files of other stores are the same files; none of the store's is
        assert same == {n for n in old if f"StoreId={STORE}/" not in n}, table
        assert {n for n in new if n not in same} == {n for n in new if f"StoreId={STORE}/" in n}
    assert {kind for name, kind in state.read("facts").dtypes if name not in ("Year", "StoreId", "Family")} == {"bigint"}  # exact sums
    assert state.apply("b1", inputs.products, movements, sales) is None
    assert RetailState.open(spark, state.folder).about["batches"] == ["first", "b1"]


def test_years_before_the_batch_stay(spark, inputs):
    new = (F.col("Date") > "2000-03-01") & (F.col("StoreId") <= 4)
    first, movements, sales = parts(inputs, new)
    state = create(spark, first, "until spring")
    before = {n: t for n, t in file_times(state.folder, "daily").items() if n.startswith("daily/Year=1999")}
    assert state.apply("spring", inputs.products, movements, sales).first_year == 2000
    assert {n: t for n, t in file_times(state.folder, "daily").items() if n.startswith("daily/Year=1999")} == before
    assert published(state) == full(spark, inputs, "whole")


def test_a_lost_driver_is_finished_by_the_next_open(spark, inputs, monkeypatch):
    first, movements, sales = parts(inputs, is_new(STORE))
    state = create(spark, first, "without")
    want_before, want = published(state), full(spark, inputs, "whole")

    class Killed(Exception):
        pass

    def killed(*_):
        raise Killed

    # before the journal: nothing has changed
    monkeypatch.setattr(files, "replace_text", killed)
    with pytest.raises(Killed):
        state.apply("b1", inputs.products, movements, sales)
    monkeypatch.undo()
    assert published(RetailState.open(spark, state.folder)) == want_before
    # between two tables: the staged partitions are put in place
    exists = files.exists
    monkeypatch.setattr(files, "exists", lambda s, p: killed() if p.endswith("_staged/daily") else exists(s, p))
    with pytest.raises(Killed):
        state.apply("b1", inputs.products, movements, sales)
    monkeypatch.undo()
    again = RetailState.open(spark, state.folder)
    assert published(again) == want and again.apply("b1", inputs.products, movements, sales) is None


def test_stock_that_ends_leaves_no_partition_behind(spark, inputs):
    """A batch that takes all stock of a store away: its partitions go."""
    state = create(spark, inputs, "whole")
    cube = state.read("cube").where(F.col("StoreId") == STORE)
    first_day = cube.agg(F.min("Date")).first()[0]
    products = {r["ProductRootCode"]: r["ProductId"] for r in inputs.products.dropna().collect()}
    drained = [(STORE, p, first_day, -1_000_000) for p in products.values()]
    movements = spark.createDataFrame(drained, inputs.stock_movements.schema)
    assert os.path.isdir(f"{state.folder}/daily/Year=2000/StoreId={STORE}")
    state.apply("drain", inputs.products, movements)
    assert not os.path.isdir(f"{state.folder}/daily/Year=2000/StoreId={STORE}") and not os.path.isdir(f"{state.folder}/intervals/StoreId={STORE}")
    assert published(state) == full(spark, Inputs(inputs.products, inputs.sales, inputs.stock_movements.unionByName(movements)), "drained")


def test_refusals_and_empty_batches(spark, inputs):
    state = create(spark, inputs, "whole")
    before = published(state)
    none = inputs.stock_movements.limit(0)
    applied = state.apply("empty", inputs.products, none, inputs.sales.limit(0))
    assert (applied.stores, applied.keys, applied.first_year) == ([], 0, None) and published(state) == before
    after_the_period = spark.createDataFrame([(1, 1, d("2003-01-01"), 5)], inputs.stock_movements.schema)
    state.apply("later", inputs.products, after_the_period)
    assert published(state) == before
    moved = inputs.products.withColumn("Family", F.lit("elsewhere"))
    with pytest.raises(ValueError, match="dimension has changed"):
        state.apply("b", moved, none)
    with pytest.raises(ValueError, match="not empty"):
        RetailState.create(spark, state.folder, inputs, FIXTURE_PERIOD)
    with pytest.raises(ValueError, match="no state"):
        RetailState.open(spark, tempfile.mkdtemp())


def test_many_stores_share_partition_folders(spark, monkeypatch):
    """150 stores: a few folders and files in each table, and a batch gives the result of a state over all rows."""
    products = make_products(spark, [(p // 2, p, 1.0, 2.0, f"f{p % 3}") for p in range(1, 9)])
    rows = [(s, p, f"{1998 + (s + p) % 3}-0{1 + p}-1{s % 10}", 1 + (s * p) % 7) for s in range(1, 151) for p in range(1, 9)]
    moved, sold = make_facts(spark, rows), make_facts(spark, rows, schemas.SALES)
    late = (F.col("StoreId") % 50 == 1) & (F.col("Date") > "2000-03-01")

    def state_of(movements, sales):
        folder = tempfile.mkdtemp(prefix="stockroom-state-") + "/s"
        return RetailState.create(spark, folder, Inputs(products, sales, movements), FIXTURE_PERIOD, FIXTURE_PRICE_SCALE)

    whole, state = state_of(moved, sold), state_of(moved.where(~late), sold.where(~late))
    before = {t: file_times(state.folder, t) for t in ("cube", "intervals", "daily", "facts")}
    assert all(len(found) < 150 for found in before.values()), {t: len(found) for t, found in before.items()}
    assert not any("StoreId=" in name for found in before.values() for name in found)
    assert state.apply("late", products, moved.where(late), sold.where(late)).stores == [1, 51, 101]
    assert published(state) == published(whole)
    assert collect_sorted(state.read("facts").where("StoreId = 51").select("StoreId", "Family")) == collect_sorted(whole.read("facts").where("StoreId = 51").select("StoreId", "Family"))
    for table, old in before.items():  # three stores are in at most three of the folders
        changed = {n for n, t in file_times(state.folder, table).items() if old.get(n) != t}
        assert len({n.rpartition("/")[0].rpartition("/")[2] for n in changed}) <= 3, table

    # a driver lost between two moves of a table: the next open goes on, and does not take what was moved for gone
    again = state_of(moved.where(~late), sold.where(~late))
    move, moves = files.move, []

    class Killed(Exception):
        pass

    def some(spark, source, target):
        if len(moves) == 4:
            raise Killed
        moves.append(target)
        move(spark, source, target)

    monkeypatch.setattr(files, "move", some)
    with pytest.raises(Killed):
        again.apply("late", products, moved.where(late), sold.where(late))
    monkeypatch.undo()
    assert len(moves) == 4 and published(RetailState.open(spark, again.folder)) == published(whole)


def test_days_before_the_quarter_of_a_batch_stay(spark, inputs, monkeypatch):
    """Where a year's folder would hold more than a task's rows it is cut by quarter, and a batch rewrites from its quarter on."""
    monkeypatch.setattr(pipeline, "DEFAULT_DAILY_ROWS_PER_TASK", 6_000)
    new = (F.col("Date") > "2000-08-15") & (F.col("StoreId") <= 4)
    first, movements, sales = parts(inputs, new)
    state = RetailState.create(spark, tempfile.mkdtemp(prefix="stockroom-state-") + "/s", first, FIXTURE_PERIOD, FIXTURE_PRICE_SCALE)
    before = file_times(state.folder, "daily")
    assert before and all("/Quarter=" in name for name in before)
    applied = state.apply("autumn", inputs.products, movements, sales)
    assert published(state) == full(spark, inputs, "whole")
    after = file_times(state.folder, "daily")
    touched = {f"daily/Year=2000/StoreId={s}/Quarter={q}" for s in applied.stores for q in (3, 4)}
    changed = {name.rpartition("/")[0] for name in before if after.get(name) != before[name]}
    assert changed and changed <= touched
    assert {name.rpartition("/")[0] for name in after if name not in before} <= touched

    # all stock of a store taken away from spring on: its later quarters go, its year's folder stays; then its years go too
    products = {r["ProductRootCode"]: r["ProductId"] for r in inputs.products.dropna().collect()}
    place = f"{state.folder}/daily/Year=2000/StoreId={STORE}"
    for batch, day, left in (("spring", d("2000-04-01"), ["Quarter=1"]), ("ever", d("1992-01-01"), None)):
        drained = spark.createDataFrame([(STORE, p, day, -1_000_000) for p in products.values()], inputs.stock_movements.schema)
        state.apply(batch, inputs.products, drained)
        assert (sorted(os.listdir(place)) if os.path.isdir(place) else None) == left
        assert state.table("daily_stock").where((F.col("StoreId") == STORE) & (F.col("Date") >= F.lit(day))).count() == 0
    assert RetailState.open(spark, state.folder).about["quarters"] is True


def test_quarters_of_days(spark):
    """The rows by quarter are the daily rows, each in its quarter; a state from before there were quarters has none."""
    days = [("1999-11-30", "2000-02-29"), ("2000-03-31", "2000-04-01"), ("2000-12-31", "2000-12-31"), ("2000-01-02", "2000-01-01")]
    schema = "ProductRootCode int, StoreId int, StartDate date, EndDate date, Stock bigint"
    iv = spark.createDataFrame([(i, 1, d(a), d(b), i + 5) for i, (a, b) in enumerate(days)], schema)
    grain = ("ProductRootCode", "StoreId")
    found = densify_by_year(iv, grain, 3, ["Year", "StoreId", "Quarter"])
    want = densify_daily(iv, grain).withColumns({"Year": F.year("Date"), "Quarter": F.quarter("Date")})
    assert found.columns == want.columns and collect_sorted(found) == collect_sorted(want) and want.count() == 95
    folder = tempfile.mkdtemp(prefix="stockroom-state-")
    files.write_text(spark, f"{folder}/_STATE", '{"period": ["1999-01-01", "2000-12-31"], "price_scale": 2, "products": "", "batches": []}')
    assert {k: RetailState.open(spark, folder).about[k] for k in ("groups", "quarters")} == {"groups": 0, "quarters": False}
