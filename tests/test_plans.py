"""Plan shape: shuffles, pushed filters, pruned columns, broadcast only after a size check."""

from __future__ import annotations

import contextlib
import os

from conftest import SF_SMALL

from stockroom.config import FAMILY_GRAIN, FIXTURE_PERIOD, ROOT_GRAIN
from stockroom.operators import clean, enrich, kpi_facts, kpi_summary, ledger, period_filter, sized_broadcast
from stockroom.operators.enrich import measured_size_bytes
from stockroom.plans import plan_counts, plan_text
from stockroom.plans.pipeline import movement_cube
from stockroom.sources import derive_inputs

P = FIXTURE_PERIOD


def _inputs(spark):
    raw = derive_inputs(spark, SF_SMALL)
    return clean(raw.products), clean(raw.sales), clean(raw.stock_movements)


def test_ledger_has_two_exchanges_and_one_window(spark):
    products, _, movements = _inputs(spark)
    iv = ledger(enrich(movements, products, ["ProductRootCode"]), ROOT_GRAIN, P)
    counts = plan_counts(iv)
    # netting (partial aggregate, then shuffle on key+day) and the window shuffle on the key
    assert counts["Exchange"] == 2
    assert counts["Window"] == 1
    assert counts["Sort"] == 1
    assert counts["BroadcastExchange"] == 1


def test_root_ledger_from_the_cube_needs_one_exchange(spark, tmp_path):
    products, _, movements = _inputs(spark)
    path = str(tmp_path / "cube")
    movement_cube(movements, products, P).write.parquet(path)
    cube = spark.read.parquet(path).select(*ROOT_GRAIN, "Date", "Quantity")
    counts = plan_counts(ledger(cube, ROOT_GRAIN, P, colocate=True))
    assert counts["Exchange"] == 1 and counts["Window"] == 1
    assert plan_counts(ledger(cube, ROOT_GRAIN, P))["Exchange"] == 2


def test_netting_aggregates_before_every_shuffle(spark):
    """A hot key cannot send its raw movements through a shuffle: each map task pre-sums them."""
    products, _, movements = _inputs(spark)
    iv = ledger(enrich(movements, products, ["ProductRootCode"]), ROOT_GRAIN, P)
    physical = plan_text(iv).split("== Physical Plan ==")[-1].splitlines()
    exchanges = [i for i, line in enumerate(physical) if "Exchange hashpartitioning" in line]
    # the deepest exchange (nearest the scan) sits right above the partial aggregate
    assert "partial_sum(Quantity" in physical[exchanges[-1] + 1]


def test_kpi_summary_aggregates_once(spark):
    products, sales, movements = _inputs(spark)
    sales_e = enrich(period_filter(sales, P), products, ["Family", "RetailPrice"])
    inbound_e = enrich(period_filter(movements, P), products, ["Family", "SupplierPrice"])
    fam = ledger(enrich(movements, products, ["Family"]), FAMILY_GRAIN, P)
    counts = plan_counts(kpi_summary(kpi_facts(sales_e, inbound_e, fam)))
    # one shuffle for the sums per (Year, StoreId, Family), one for the GROUPING SETS of that small
    # result, two for the family ledger
    assert counts["Exchange"] == 4
    lines = plan_text(kpi_summary(kpi_facts(sales_e, inbound_e, fam))).split("== Physical Plan ==")[-1].splitlines()
    below = [lines[i + 1] for i, line in enumerate(lines) if "Expand" in line]
    assert below and all("HashAggregate" in line for line in below)


def test_audits_scan_the_facts_once_and_measure_once(spark):
    """A query measures the product dimension once, while it is built, and scans lineitem once."""
    from stockroom.plans import catalog

    for name in ("reconcile_quantity", "compare_grains"):
        jobs = []
        measured = catalog.E.measured_size_bytes
        catalog.E.measured_size_bytes = lambda df: jobs.append(name) or measured(df)
        try:
            df = catalog.QUERIES[name](spark, SF_SMALL)
        finally:
            catalog.E.measured_size_bytes = measured
        assert len(jobs) == 1, name
        # the plan reads the written intermediate; lineitem was scanned once to write it
        assert "lineitem" not in plan_text(df)
    text = plan_text(catalog.QUERIES["days_in_year"](spark, SF_SMALL))
    assert "Window" not in text and text.split("== Physical Plan ==")[-1].count("FileScan") == 1


def test_daily_query_is_spread_over_tasks(spark):
    """Several million days from few intervals, under default AQE: more than one task, bounded rows each."""
    from pyspark.sql import functions as F

    from stockroom.plans.pipeline import daily_table

    keys = spark.range(6000).select(
        F.col("id").cast("int").alias("ProductRootCode"),
        F.lit(1).alias("StoreId"),
        F.lit("1999-01-01").cast("date").alias("StartDate"),
        F.lit("2000-12-31").cast("date").alias("EndDate"),
        F.lit(3).cast("long").alias("Stock"),
    )
    tasks = daily_table(keys, ROOT_GRAIN, 500_000).groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in tasks) == 6000 * 731
    assert len(tasks) > 4 and max(r["count"] for r in tasks) < 1_000_000


def test_period_filter_reaches_the_scan(spark, tmp_path):
    products, sales, _ = _inputs(spark)
    path = str(tmp_path / "sales.parquet")
    sales.write.parquet(path)
    text = plan_text(period_filter(spark.read.parquet(path), P).select("StoreId", "Quantity"), "formatted")
    pushed = next(line for line in text.splitlines() if line.startswith("PushedFilters:"))
    assert "GreaterThan(Quantity,0)" in pushed
    assert "GreaterThanOrEqual(Date,1999-01-01)" in pushed and "LessThanOrEqual(Date,2000-12-31)" in pushed
    read_schema = next(line for line in text.splitlines() if line.startswith("ReadSchema:"))
    assert "ProductId" not in read_schema


def test_broadcast_only_below_the_measured_size(spark):
    products, _, _ = _inputs(spark)
    dim = products.select("ProductId", "Family")
    size = measured_size_bytes(dim)
    assert 0 < size < 1_000_000
    assert "ResolvedHint (strategy=broadcast)" in plan_text(sized_broadcast(dim, size), "extended")
    assert "strategy=broadcast" not in plan_text(sized_broadcast(dim, size - 1), "extended")


def test_broadcast_hint_survives_the_per_join_selection(spark):
    """The job measures and hints the product dimension once, then each join selects its columns."""
    products, sales, movements = _inputs(spark)
    auto = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(auto)
    spark.conf.set(auto, "-1")  # no size-based broadcast: only the explicit hint can broadcast
    try:
        plain = enrich(period_filter(sales, P), products, ["Family"], broadcast_max_bytes=None)
        assert plan_counts(plain)["BroadcastExchange"] == 0
        dim = sized_broadcast(products.select("ProductId", "ProductRootCode", "Family", "RetailPrice"))
        joined = enrich(period_filter(sales, P), dim, ["Family", "RetailPrice"], broadcast_max_bytes=None)
        assert plan_counts(joined)["BroadcastExchange"] == 1
        priced = dim.withColumn("SupplierPriceUnits", dim.ProductId.cast("long"))
        assert plan_counts(movement_cube(movements, priced, P, 2, None))["BroadcastExchange"] == 1
    finally:
        spark.conf.set(auto, before)


def test_a_hot_product_is_split_above_the_broadcast_bound(spark, tmp_path):
    """With the bound at 0 the product join shuffles; a product with a third of the facts is split by AQE, also in
    the counting form, and the result is that of the broadcast."""
    from pyspark.sql import functions as F

    from stockroom.operators import enrich_marked
    from stockroom.plans.pipeline import Counts, matched
    from stockroom.sources.parquet import setting

    products, _, movements = _inputs(spark)
    hot = products.select(F.min("ProductId")).first()[0]
    n = movements.count()
    copies = movements.withColumn("ProductId", F.lit(hot)).limit(n // 2)
    movements.unionByName(copies).withColumn("Note", F.repeat(F.lit("x"), F.col("Quantity") % 7 + 60)).repartition(16).write.parquet(f"{tmp_path}/m")
    facts = spark.read.parquet(f"{tmp_path}/m")
    cols = ["ProductRootCode", "Family"]
    want = enrich(facts, products, cols)
    total = want.count()
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.files.maxPartitionBytes": "16k", "spark.sql.files.openCostInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    with contextlib.ExitStack() as stack:
        for key, value in settings.items():
            stack.enter_context(setting(spark, key, value))
        counts = Counts()
        for joined in (
            enrich(facts, products, cols, 0),
            enrich_marked(facts, products, cols, 0).where("Family IS NOT NULL"),
            matched(facts, products, cols, "facts", F.lit(True), counts),
        ):
            assert plan_counts(joined)["BroadcastExchange"] == 0
            path = f"{tmp_path}/{joined.semanticHash()}-{len(os.listdir(tmp_path))}"
            joined.select(F.spark_partition_id().alias("task"), *want.columns).write.parquet(path)
            back = spark.read.parquet(path)
            sizes = [r["count"] for r in back.groupBy("task").count().collect()]
            assert sum(sizes) == total and max(sizes) < total / 8, sorted(sizes)[-3:]
            assert back.drop("task").exceptAll(want).count() == 0
        assert counts.settle() == {"unmatched_facts": facts.count() - total}


def test_audits_sum_each_frame_by_itself(spark):
    """No daily row is tagged or unioned: what meets the union of the balances is one row of each frame."""
    from pyspark.sql import functions as F

    from stockroom.operators import compare_grains, densify_daily, reconcile_days

    days = [F.lit(x).cast("date").alias(c) for c, x in (("StartDate", "1999-01-01"), ("EndDate", "1999-01-10"))]
    iv = spark.range(5).select(F.col("id").cast("int").alias("ProductRootCode"), F.lit(1).alias("StoreId"), *days, F.lit(3).cast("long").alias("Stock"))
    balance = reconcile_days(iv, densify_daily(iv, ("ProductRootCode", "StoreId")))
    assert tuple(balance.first()) == (50, 50, True)
    assert tuple(reconcile_days(iv.limit(0), densify_daily(iv, ("ProductRootCode", "StoreId"))).first()) == (0, 50, False)
    for df in (balance, compare_grains(iv, iv)):
        assert plan_counts(df)["Exchange"] == 2  # one for each frame's sum
