"""The Bloom filter of a dimension's keys before a fact join (C3, C4 above the broadcast bound)."""

from __future__ import annotations

import contextlib

import pytest
from conftest import SF_SMALL, make_facts, make_products
from pyspark.sql import functions as F

from stockroom.operators import clean, enrich, enrich_filtered, filter_bits, may_contain, unmatched
from stockroom.plans.pipeline import Counts, matched
from stockroom.plans import plan_counts, plan_text
from stockroom.sources import derive_inputs
from stockroom.sources.parquet import setting

COLS = ["ProductRootCode", "Family"]


@pytest.fixture(scope="module")
def tables(spark):
    f = derive_inputs(spark, SF_SMALL)
    return clean(f.products), clean(f.stock_movements)


@pytest.mark.parametrize("bits", [None, 64, 1 << 12, 1 << 20])
def test_the_result_does_not_depend_on_the_filter(spark, tables, bits):
    """A saturated filter (64 bits) passes everything, a wide one nearly only members: the join decides."""
    products, facts = tables
    want, got = enrich(facts, products, COLS), enrich_filtered(facts, products, COLS, bits)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_members_pass_and_strangers_do_not(spark):
    dim = spark.range(20_000).select((F.col("id") * 3).cast("int").alias("k"))
    asked = spark.range(60_000).select(F.col("id").alias("k")).unionByName(spark.createDataFrame([(None,)], "k long"))
    held = asked.withColumn("may", may_contain(asked, dim, "k"))
    known = F.col("k") % 3 == 0
    row = held.agg(F.count_if(known & ~F.col("may")), F.count_if(~known & F.col("may")), F.count_if(F.col("k").isNull() & F.col("may"))).first()
    assert row[0] == 0 and row[2] == 0
    assert row[1] < 0.06 * 40_000


def test_empty_dimension_and_null_keys(spark):
    facts = make_facts(spark, [(1, 1, "2019-01-01", 5), (1, 2, "2019-01-02", 5)])
    none = make_products(spark, [])
    assert enrich_filtered(facts, none, COLS).count() == 0
    some = make_products(spark, [(7, 2, 1.0, 2.0, "f"), (7, None, 1.0, 2.0, "f")])
    assert [r.ProductId for r in enrich_filtered(facts, some, COLS).collect()] == [2]
    assert enrich_filtered(facts.limit(0), some, COLS).count() == 0


def test_types_that_a_join_would_convert_are_refused(spark):
    facts, dim = spark.createDataFrame([("1",)], "k string"), spark.createDataFrame([(1,)], "k int")
    with pytest.raises(TypeError, match="string in the facts and int"):
        may_contain(facts, dim, "k")


def test_sizes_are_bounded():
    assert filter_bits(0) == filter_bits(8) == 64
    assert filter_bits(1_000) == 1 << 13
    assert filter_bits(10**12) == 1 << 26


def test_unknown_facts_are_dropped_before_the_shuffle(spark, tables, tmp_path):
    """With the bound at 0, only the facts that pass the filter are shuffled, in the scan's own stage."""
    products, facts = tables
    kept = products.where(F.col("ProductId") % 10 == 0)
    facts.write.parquet(f"{tmp_path}/m"), kept.write.parquet(f"{tmp_path}/p")
    facts, kept = spark.read.parquet(f"{tmp_path}/m"), spark.read.parquet(f"{tmp_path}/p")
    with contextlib.ExitStack() as stack:
        for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            stack.enter_context(setting(spark, key, "-1"))
        plain, filtered = enrich(facts, kept, COLS, 0), enrich_filtered(facts, kept, COLS)
        assert plan_counts(filtered)["BroadcastExchange"] == 0
        plan = plan_text(filtered)
        scan = plan[plan.index("SortMergeJoin") :]
        first = scan.index("Exchange")
        assert "xxhash64" in scan[first : scan.index("FileScan")]
        assert filtered.exceptAll(plain).count() == plain.exceptAll(filtered).count() == 0
    passed = facts.where(may_contain(facts, kept, "ProductId")).count()
    assert plain.count() <= passed <= plain.count() + 0.06 * facts.count()


def test_the_counts_of_the_job_stay_the_same(spark, tables, tmp_path):
    products, facts = tables
    scope = F.col("Quantity") > 0
    want = unmatched(facts.where(scope), products).count()
    for bits in (None, 64, 1 << 16):
        counts = Counts()
        rows = matched(facts, products, COLS, "facts", scope, counts, None, bits)
        rows.write.parquet(f"{tmp_path}/{bits}")
        assert counts.settle() == {"unmatched_facts": want} == counts.values
        assert spark.read.parquet(f"{tmp_path}/{bits}").count() == enrich(facts, products, COLS).count()
