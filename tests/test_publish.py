"""One version of all tables: what an interrupted run leaves, foreign folders, counts and guards of the job."""

from __future__ import annotations

import os
import tempfile

import pytest
from conftest import SF_SMALL, collect_sorted
from pyspark.sql import functions as F

from stockroom import schemas
from stockroom.config import FIXTURE_PERIOD, FIXTURE_PRICE_SCALE, ROOT_GRAIN, Period
from stockroom.operators import ledger, null_rejects, quality, unmatched
from stockroom.operators.enrich import period_filter
from stockroom.plans import plan_counts, plan_text, publish, run_pipeline
from stockroom.plans.catalog import QUERIES
from stockroom.plans.pipeline import save_cube
from stockroom.sources import derive_inputs, files, read_inputs, write_inputs
from stockroom.sources.bucketed import forget, load_bucketed

SMALL = ("interval_stock", "store_benefits", "store_rotation")
ONE_YEAR = Period.of("1999-01-01", "1999-12-31")


class Killed(Exception):
    pass


@pytest.fixture(scope="module")
def in_dir(spark):
    path = tempfile.mkdtemp(prefix="stockroom-in-")
    write_inputs(spark, SF_SMALL, path)
    return path


def job(spark, out_dir, in_dir, period=FIXTURE_PERIOD, **more):
    return run_pipeline(spark, out_dir, in_dir=in_dir, period=period, price_scale=FIXTURE_PRICE_SCALE, **{"tables": SMALL} | more)


def killed_after(step):
    def on_step(name, _):
        if name == step:
            raise Killed(name)

    return on_step


@pytest.mark.parametrize("layout", publish.LAYOUTS)
def test_a_run_killed_between_two_tables_leaves_the_previous_version(spark, in_dir, out_dir, layout):
    first = job(spark, out_dir, in_dir, layout=layout)
    before = {t: collect_sorted(publish.read_published(spark, out_dir, t)) for t in SMALL}
    with pytest.raises(Killed):
        job(spark, out_dir, in_dir, ONE_YEAR, layout=layout, on_step=killed_after("interval_stock"))
    assert {t: collect_sorted(publish.read_published(spark, out_dir, t)) for t in SMALL} == before
    job(spark, out_dir, in_dir, ONE_YEAR, layout=layout)
    interval_stock, rotation = publish.read_published(spark, out_dir, "interval_stock", "store_rotation")
    assert interval_stock.agg(F.max(F.to_date("EndDate"))).first()[0] == ONE_YEAR.end
    assert {r["Year"] for r in rotation.collect()} == {1999}
    assert first.out_dir == out_dir


def test_versions_stay_until_they_expire(spark, in_dir, out_dir):
    for period in (FIXTURE_PERIOD, ONE_YEAR):
        job(spark, out_dir, in_dir, period, layout="versions", tables=("interval_stock", "store_benefits"))
    third = job(spark, out_dir, in_dir, layout="versions", tables=("store_rotation",))
    pointer = publish.current(spark, out_dir)
    assert set(pointer["tables"]) == set(SMALL) and pointer["counts"] == third.counts
    # tables that a run did not make are those of the version before
    assert publish.read_published(spark, out_dir, "interval_stock").agg(F.max(F.to_date("EndDate"))).first()[0] == ONE_YEAR.end
    staged = publish.Publication(spark, out_dir, "versions")  # a run that never commits
    spark.range(3).write.parquet(f"{out_dir}/_versions/not_ours/t.parquet")
    gone = publish.expire(spark, out_dir, keep=1)
    assert len(gone) == 2 and staged.version in gone
    assert publish.read_published(spark, out_dir, "store_rotation").count() == 20
    assert files.exists(spark, f"{out_dir}/_versions/not_ours/t.parquet")


def test_an_interrupted_flat_commit_is_finished(spark, out_dir, monkeypatch):
    def published(value):
        run = publish.Publication(spark, out_dir)
        for name in ("a", "b"):
            spark.range(value).write.parquet(run.path(name))
        return run

    published(3).commit()
    second, move, moved = published(5), files.move, []

    def killed_move(spark, source, target):
        if len(moved) == 3:  # a's old and new folders and b's old folder are moved
            raise Killed
        moved.append(target)
        move(spark, source, target)

    monkeypatch.setattr(files, "move", killed_move)
    with pytest.raises(Killed):
        second.commit()
    monkeypatch.setattr(files, "move", move)
    assert publish.recover(spark, out_dir) and not publish.recover(spark, out_dir)
    assert [spark.read.parquet(f"{out_dir}/{n}.parquet").count() for n in "ab"] == [5, 5]
    assert sorted(os.listdir(out_dir)) == ["a.parquet", "b.parquet"]


def test_an_incomplete_table_is_not_published(spark, out_dir):
    run = publish.Publication(spark, out_dir)
    spark.range(3).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(run.path("a"))
    with pytest.raises(RuntimeError, match="not complete"):
        run.commit()
    run.discard()
    assert os.listdir(out_dir) == []
    with pytest.raises(ValueError, match="layout"):
        publish.Publication(spark, out_dir, "other")


def test_a_foreign_folder_is_refused(spark, in_dir, out_dir):
    foreign = tempfile.mkdtemp(prefix="stockroom-foreign-")
    with open(f"{foreign}/thesis.txt", "w") as f:
        f.write("years of work")
    with pytest.raises(ValueError, match="no scratch folder"):
        job(spark, out_dir, in_dir, scratch_dir=foreign)
    assert os.listdir(foreign) == ["thesis.txt"] and os.listdir(out_dir) == []


def test_other_files_in_a_scratch_folder_stay(spark, in_dir, out_dir):
    run = job(spark, out_dir, in_dir, tables=("interval_stock",), keep_scratch=True)
    files.write_text(spark, f"{run.scratch_dir}/notes.txt", "mine")
    again = job(spark, out_dir, in_dir, tables=("interval_stock",), scratch_dir=run.scratch_dir)
    assert again.reused == ["movement_cube", "root_intervals"]
    assert files.names(spark, run.scratch_dir) == ["_STOCKROOM_SCRATCH", "notes.txt"]


def test_counts_equal_the_audits_without_a_further_scan(spark, in_dir, out_dir):
    raw = read_inputs(spark, in_dir)
    products = quality.clean(raw.products)
    sales, movements = (period_filter(quality.clean(df), FIXTURE_PERIOD) for df in (raw.sales, raw.stock_movements))
    want = {
        "products_rows": raw.products, "null_products": null_rejects(raw.products),
        "sales_rows": raw.sales, "null_sales": null_rejects(raw.sales), "unmatched_sales": unmatched(sales, products),
        "movements_rows": raw.stock_movements, "null_movements": null_rejects(raw.stock_movements),
        "unmatched_movements": unmatched(movements, products), "daily_rows": QUERIES["daily_stock"](spark, SF_SMALL),
    }
    want = {name: df.count() for name, df in want.items()}
    run = job(spark, out_dir, in_dir, tables=None, keep_scratch=True)
    assert want.items() <= run.counts.items() and min(want.values()) > 0
    assert run.counts["interval_days"] == run.counts["daily_rows"] and run.counts["movement_quantity"] == run.counts["cube_quantity"]
    # a resumed run knows the counts of the tables that it reuses
    again = job(spark, tempfile.mkdtemp(), in_dir, tables=None, scratch_dir=run.scratch_dir)
    assert len(again.reused) == 3 and again.counts == run.counts
    plain = job(spark, out_dir, in_dir, counted=False)
    assert plain.counts == {}


def test_a_count_that_does_not_balance_is_taken_again(spark, in_dir, out_dir, monkeypatch):
    from stockroom.plans import pipeline

    settle = pipeline.Counts.settle
    doubled = lambda self: {k: v * 2 if k == "movement_quantity" else v for k, v in settle(self).items()}
    monkeypatch.setattr(pipeline.Counts, "settle", doubled)  # as if a stage had run twice
    run = job(spark, out_dir, in_dir)
    assert run.counts["movement_quantity"] == run.counts["cube_quantity"]
    monkeypatch.setattr(pipeline, "with_snapshot", None)
    cube = pipeline.movement_cube
    monkeypatch.setattr(pipeline, "movement_cube", lambda *a: cube(*a).withColumn("Quantity", F.col("Quantity") + 1))
    with pytest.raises(RuntimeError, match="C27"):
        job(spark, out_dir, in_dir)


def test_a_duplicated_product_stops_the_job(spark, in_dir, out_dir):
    raw = read_inputs(spark, in_dir)
    twice = tempfile.mkdtemp(prefix="stockroom-in-")
    for name in ("sales", "stock_movements"):
        os.symlink(f"{in_dir}/{name}.parquet", f"{twice}/{name}.parquet")
    some = quality.clean(raw.products).limit(1)
    raw.products.unionByName(some).write.parquet(f"{twice}/products.parquet")
    with pytest.raises(Exception, match="1 rows repeat the ProductId"):
        job(spark, out_dir, twice)
    assert not files.exists(spark, f"{out_dir}/interval_stock.parquet")
    allowed = job(spark, out_dir, twice, allow_duplicate_products=True)
    once = job(spark, tempfile.mkdtemp(), in_dir)
    assert allowed.counts["movement_quantity"] != once.counts["movement_quantity"]


def test_the_bucketed_cube_needs_no_exchange_and_no_sort(spark):
    from stockroom.plans.catalog import Frames
    from stockroom.plans.pipeline import root_intervals
    from stockroom.session import scratch_path

    path = scratch_path(spark, "cube")
    cube = save_cube(Frames(spark, SF_SMALL).cube(), path, 8)
    for table in (cube, load_bucketed(spark, path)):
        counts = plan_counts(root_intervals(table, FIXTURE_PERIOD, ordered=True))
        assert (counts["Exchange"], counts["Sort"], counts["Window"]) == (0, 0, 1)
        got = root_intervals(table, FIXTURE_PERIOD, ordered=True)
        assert collect_sorted(got) == collect_sorted(QUERIES["interval_stock"](spark, SF_SMALL))
    before = {t.name for t in spark.catalog.listTables()}
    forget(spark, path)
    after = {t.name for t in spark.catalog.listTables()}
    assert len(before - after) == 2 and spark.read.parquet(path).count() > 0
    with pytest.raises(FileNotFoundError):
        load_bucketed(spark, path + "-other")


def test_a_hot_key_is_no_hot_bucket(spark, tmp_path):
    """A (root, store) with a third of all movements has at most a row a day in the cube."""
    raw = derive_inputs(spark, SF_SMALL)
    product = quality.clean(raw.products).select("ProductId").first()[0]
    movements = quality.clean(raw.stock_movements)
    hot = movements.withColumns({"ProductId": F.lit(product), "StoreId": F.lit(1)})
    skewed = movements.unionByName(hot).unionByName(hot.limit(hot.count() // 2))
    from stockroom.plans.pipeline import movement_cube, root_intervals

    cube = save_cube(movement_cube(skewed, quality.clean(raw.products), FIXTURE_PERIOD, FIXTURE_PRICE_SCALE), f"{tmp_path}/cube", 16)
    sizes = [r["count"] for r in cube.groupBy(F.input_file_name()).count().collect()]
    days = movements.select("Date").distinct().count()
    assert max(sizes) <= days + 2 * movements.count() / 16
    want = ledger(skewed.join(quality.clean(raw.products).select("ProductId", "ProductRootCode"), "ProductId"), ROOT_GRAIN, FIXTURE_PERIOD)
    assert collect_sorted(root_intervals(cube, FIXTURE_PERIOD, ordered=True)) == collect_sorted(want)


def test_daily_table_by_year_is_written_without_a_sort_of_its_rows(spark, out_dir):
    from stockroom.plans.pipeline import daily_table
    from stockroom.sources import write_table
    from stockroom.sources.parquet import setting

    intervals = QUERIES["interval_stock"](spark, SF_SMALL)
    daily = daily_table(intervals, ROOT_GRAIN, 30_000, by_year=True)
    path = f"{out_dir}/daily_stock.parquet"
    write_table(daily, path, contract=schemas.DAILY_STOCK, by_year=True)
    for year in (1999, 2000):
        assert 1 <= len([n for n in os.listdir(f"{path}/Year={year}") if n.endswith(".parquet")]) <= 5
    back = spark.read.parquet(path)
    want = QUERIES["daily_stock"](spark, SF_SMALL)
    got = back.select("ProductRootCode", "StoreId", F.to_date("Date").alias("Date"), "Stock")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    assert back.where(F.year("Date") != F.col("Year")).count() == 0
    assert "PartitionFilters: [isnotnull(Year" in plan_text(back.where("Year = 2000"))
    # the plan of the insert: the daily rows are not sorted, only the intervals below the explode
    daily.createOrReplaceTempView("daily_rows")
    spark.sql(f"CREATE TABLE stockroom_by_year (ProductRootCode INT, StoreId INT, Date DATE, Stock BIGINT, Year INT) USING parquet PARTITIONED BY (Year) LOCATION '{out_dir}/plan'")
    try:
        explain = "EXPLAIN INSERT INTO stockroom_by_year SELECT * FROM daily_rows"
        with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "16"):
            text = spark.sql(explain).first()[0]
        above = lambda plan: plan[: plan.index("Generate")].count("Sort [")
        assert above(text) == 0 and above(spark.sql(explain).first()[0]) == 1
    finally:
        spark.sql("DROP TABLE stockroom_by_year")


def test_a_filtered_run_gives_the_same_tables_and_counts(spark, in_dir, out_dir):
    plain = job(spark, out_dir, in_dir)
    filtered = job(spark, tempfile.mkdtemp(), in_dir, filter_facts=True, broadcast_max_bytes=0)
    assert filtered.counts == plain.counts
    for table in SMALL:
        assert collect_sorted(publish.read_published(spark, filtered.out_dir, table)) == collect_sorted(publish.read_published(spark, out_dir, table))
