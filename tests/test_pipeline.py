"""End to end: fixture inputs written as Parquet -> run_pipeline -> six published tables."""

from __future__ import annotations

import os
import tempfile

import pytest
from conftest import SF_SMALL, collect_sorted
from pyspark.sql import functions as F

from stockroom import schemas
from stockroom.config import FIXTURE_PERIOD, FIXTURE_PRICE_SCALE, Period
from stockroom.plans.catalog import QUERIES
from stockroom.plans.pipeline import run_pipeline
from stockroom.sources import derive_inputs, write_inputs


@pytest.fixture(scope="module")
def published(spark):
    in_dir = tempfile.mkdtemp(prefix="stockroom-in-")
    out_dir = tempfile.mkdtemp(prefix="stockroom-out-")
    write_inputs(spark, SF_SMALL, in_dir)
    run = run_pipeline(spark, out_dir, in_dir=in_dir, period=FIXTURE_PERIOD, price_scale=FIXTURE_PRICE_SCALE, daily_rows_per_task=50_000)
    return run


def _read(spark, run, name):
    return spark.read.parquet(f"{run.out_dir}/{name}.parquet")


def test_all_steps_ran(published):
    assert set(published.seconds) >= {
        "product_dimension",
        "movement_cube",
        "root_intervals",
        "interval_stock",
        "daily_stock",
        "kpi_summary",
        "store_benefits",
        "family_benefits",
        "store_rotation",
        "family_rotation",
    }


@pytest.mark.parametrize("name", sorted(schemas.OUTPUTS))
def test_output_types(spark, published, name):
    got = _read(spark, published, name)
    # Parquet readers report every column nullable; types and names must match the contract.
    assert schemas.schema_mismatches(got, schemas.OUTPUTS[name], check_nullability=False) == []


def test_interval_stock_matches_query(spark, published):
    got = _read(spark, published, "interval_stock").select(
        "ProductRootCode", "StoreId", F.to_date("StartDate").alias("StartDate"), F.to_date("EndDate").alias("EndDate"), "Stock"
    )
    assert collect_sorted(got) == collect_sorted(QUERIES["interval_stock"](spark, SF_SMALL))


def test_daily_stock_matches_query(spark, published):
    got = _read(spark, published, "daily_stock").select(
        "ProductRootCode", "StoreId", F.to_date("Date").alias("Date"), "Stock"
    )
    want = QUERIES["daily_stock"](spark, SF_SMALL)
    assert got.count() == want.count() == 171_462
    assert got.exceptAll(want).count() == 0


@pytest.mark.parametrize("name", ["store_benefits", "family_benefits", "store_rotation", "family_rotation"])
def test_kpi_tables_match_queries(spark, published, name):
    got = _read(spark, published, name)
    want = QUERIES[name](spark, SF_SMALL)
    assert collect_sorted(got, want.columns) == collect_sorted(want)


@pytest.mark.parametrize(
    "rows,per_task,slots,want",
    [(171_462, 4_000_000, 8, 1), (120_648_427, 4_000_000, 8, 32), (10_000_000, 4_000_000, 8000, 3), (0, 10, 8, 1)],
)
def test_daily_task_count(rows, per_task, slots, want):
    from stockroom.plans.pipeline import daily_task_count

    assert daily_task_count(rows, per_task, slots) == want


def test_date_output_and_table_selection(spark):
    in_dir = tempfile.mkdtemp(prefix="stockroom-in-")
    out_dir = tempfile.mkdtemp(prefix="stockroom-out-")
    write_inputs(spark, SF_SMALL, in_dir)
    run = run_pipeline(
        spark,
        out_dir,
        in_dir=in_dir,
        period=FIXTURE_PERIOD, price_scale=FIXTURE_PRICE_SCALE,
        timestamp_output=False,
        tables=("interval_stock", "store_rotation"),
    )
    assert "daily_stock" not in run.seconds and "store_benefits" not in run.seconds
    iv = _read(spark, run, "interval_stock")
    assert iv.schema["StartDate"].dataType.simpleString() == "date"
    assert iv.count() == 1036
    assert _read(spark, run, "store_rotation").count() == 20
    assert sorted(os.listdir(out_dir)) == ["interval_stock.parquet", "store_rotation.parquet"]


def test_resume_reuses_committed_intermediates(spark, published):
    from stockroom.plans.pipeline import committed
    from stockroom.session import scratch_path

    in_dir = tempfile.mkdtemp(prefix="stockroom-in-")
    write_inputs(spark, SF_SMALL, in_dir)
    scratch = scratch_path(spark, "resume")
    assert not committed(spark, f"{scratch}/movement_cube")
    # an "interrupted" run: only the first outputs were produced before the driver went away
    first = run_pipeline(
        spark,
        tempfile.mkdtemp(),
        in_dir=in_dir,
        period=FIXTURE_PERIOD,
        price_scale=FIXTURE_PRICE_SCALE,
        tables=("interval_stock",),
        scratch_dir=scratch,
        keep_scratch=True,
    )
    assert first.reused == [] and committed(spark, f"{scratch}/movement_cube")
    out_dir = tempfile.mkdtemp(prefix="stockroom-out-")
    again = run_pipeline(spark, out_dir, in_dir=in_dir, period=FIXTURE_PERIOD, price_scale=FIXTURE_PRICE_SCALE, scratch_dir=scratch)
    assert again.reused == ["movement_cube", "root_intervals"]
    assert not committed(spark, f"{scratch}/movement_cube")  # removed when all tables are written
    for name in ("interval_stock", "store_benefits", "family_rotation"):
        got = spark.read.parquet(f"{out_dir}/{name}.parquet")
        want = _read(spark, published, name)
        assert collect_sorted(got) == collect_sorted(want.select(*got.columns))


def test_resume_refuses_tables_of_another_run(spark):
    """Intermediates of other parameters or inputs raise instead of giving another run's tables."""
    in_dir = tempfile.mkdtemp(prefix="stockroom-in-")
    write_inputs(spark, SF_SMALL, in_dir)
    only_1999 = Period.of("1999-01-01", "1999-12-31")
    run = lambda **kw: run_pipeline(spark, tempfile.mkdtemp(), in_dir=in_dir, tables=("interval_stock",), keep_scratch=True, **kw)
    first = run(period=only_1999, price_scale=FIXTURE_PRICE_SCALE)
    with pytest.raises(ValueError, match="other inputs or parameters"):
        run(period=FIXTURE_PERIOD, price_scale=FIXTURE_PRICE_SCALE, scratch_dir=first.scratch_dir)
    with pytest.raises(ValueError, match="other inputs or parameters"):
        run(period=only_1999, price_scale=4, scratch_dir=first.scratch_dir)
    assert run(period=only_1999, price_scale=FIXTURE_PRICE_SCALE, scratch_dir=first.scratch_dir).reused
    spark.read.parquet(f"{in_dir}/sales.parquet").limit(5).write.mode("append").parquet(f"{in_dir}/sales.parquet")
    with pytest.raises(ValueError, match="other inputs or parameters"):
        run(period=only_1999, price_scale=FIXTURE_PRICE_SCALE, scratch_dir=first.scratch_dir)


def test_the_job_needs_ansi_mode(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(RuntimeError, match="ansi"):
            run_pipeline(spark, tempfile.mkdtemp(), inputs=derive_inputs(spark, SF_SMALL), period=FIXTURE_PERIOD)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_contract_is_checked_with_date_output_too(spark):
    from stockroom.sources import write_table

    wrong = spark.createDataFrame([], "ProductRootCode int, StoreId int, StartDate date, EndDate date, Stock int")
    with pytest.raises(ValueError, match="Stock: int != bigint"):
        write_table(wrong, tempfile.mkdtemp() + "/t", timestamp_output=False, contract=schemas.INTERVAL_STOCK)


def test_daily_table_by_year_is_pruned(spark):
    from stockroom.plans.shape import plan_text
    from stockroom.sources import write_table

    path = tempfile.mkdtemp(prefix="stockroom-out-") + "/daily_stock.parquet"
    daily = QUERIES["daily_stock"](spark, SF_SMALL)
    write_table(daily, path, contract=schemas.DAILY_STOCK, by_year=True)
    back = spark.read.parquet(path)
    one = back.where("Year = 2000")
    assert "PartitionFilters: [isnotnull(Year" in plan_text(one)
    assert one.count() == daily.where(F.year("Date") == 2000).count() and back.count() == daily.count()


def test_empty_facts_give_empty_tables(spark):
    from stockroom.sources.parquet import Inputs

    raw = derive_inputs(spark, SF_SMALL)
    inputs = Inputs(raw.products, raw.sales.limit(0), raw.stock_movements.limit(0))
    out_dir = tempfile.mkdtemp(prefix="stockroom-out-")
    run_pipeline(spark, out_dir, inputs=inputs, period=FIXTURE_PERIOD, price_scale=FIXTURE_PRICE_SCALE)
    for name in schemas.OUTPUTS:
        assert spark.read.parquet(f"{out_dir}/{name}.parquet").count() == 0, name


def test_resume_ignores_uncommitted_folders(spark):
    """A folder without the job-commit marker (an interrupted write) is never reused."""
    from stockroom.plans.pipeline import committed

    path = tempfile.mkdtemp(prefix="stockroom-partial-") + "/movement_cube"
    spark.range(3).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    assert spark.read.parquet(path).count() == 3  # data files are there ...
    assert not committed(spark, path)  # ... but the write is not known to be complete
    spark.range(3).write.mode("overwrite").parquet(path)
    assert committed(spark, path)
