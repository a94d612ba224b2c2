"""One named query per operator, over the fixture inputs derived from a test-data folder.

Each query is a function ``(spark, sf_dir) -> DataFrame`` built only from the operators; the
period is :data:`FIXTURE_PERIOD`. Every query reads whole tables (``part`` and ``lineitem``).
Money columns are converted to DOUBLE at the end of a query; dates stay DATE.
"""

from __future__ import annotations

import datetime as dt
import importlib
import tempfile
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom import schemas
from stockroom.config import FAMILY_GRAIN, FIXTURE_PERIOD, FIXTURE_PRICE_SCALE, ROOT_GRAIN
from stockroom.functions.dates import days_in_year
from stockroom.functions.money import units_to_double
from stockroom.operators import kpi as K
from stockroom.operators import quality as Q
from stockroom.operators import snapshot as S
from stockroom.plans import pipeline as job
from stockroom.plans.incremental import RetailState
from stockroom.session import scratch_path, shared_or_local
from stockroom.sources.fixtures import derive_inputs
from stockroom.sources.parquet import Inputs, write_table

# The package re-exports functions named like these two modules, so import the modules by path.
E = importlib.import_module("stockroom.operators.enrich")
L = importlib.import_module("stockroom.operators.ledger")

P, SCALE = FIXTURE_PERIOD, FIXTURE_PRICE_SCALE
#: The day before the period, and the end of the year before: the days of the snapshot queries.
AS_OF, EARLIER = P.start - dt.timedelta(days=1), P.start - dt.timedelta(days=366)
Query = Callable[[SparkSession, str], DataFrame]


class Frames:
    """The fixture inputs of one test-data folder and the frames derived from them (lazy)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.raw = derive_inputs(spark, sf_dir)
        self.products = Q.clean(self.raw.products)
        self.sales = Q.clean(self.raw.sales)
        self.movements = Q.clean(self.raw.stock_movements)

    @cached_property
    def dimension(self) -> DataFrame:
        """The clean products with exact unit prices, measured once for all joins of a query."""
        return E.sized_broadcast(K.with_price_units(self.products, SCALE))

    def saved(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written to the shared checkpoint folder and read again."""
        shared_or_local(self.spark, tempfile.gettempdir())
        return job.save(df, scratch_path(self.spark, name))

    # --- enrichment -------------------------------------------------------------------
    def sales_in_period(self) -> DataFrame:
        return E.period_filter(self.sales, P)

    def inbounds_in_period(self) -> DataFrame:
        return E.period_filter(self.movements, P)

    def sales_enriched(self) -> DataFrame:
        return E.enrich(self.sales_in_period(), self.dimension, ["Family", "RetailPrice", "RetailPriceUnits"], None)

    def inbounds_enriched(self) -> DataFrame:
        return E.enrich(self.inbounds_in_period(), self.dimension, ["Family", "SupplierPrice", "SupplierPriceUnits"], None)

    def movements_at(self, grain: tuple[str, ...]) -> DataFrame:
        return E.enrich(self.movements, self.dimension, [grain[0]], None)

    def movements_filtered(self) -> DataFrame:
        """Movements met by the Bloom filter of the clean ProductIds before their product join."""
        return E.enrich_filtered(self.movements, self.dimension, [ROOT_GRAIN[0]])

    def unmatched(self, fact: DataFrame) -> DataFrame:
        return E.unmatched(fact, self.dimension, None)

    # --- the job's own plan -------------------------------------------------------------
    def cube(self) -> DataFrame:
        return job.movement_cube(self.movements, self.dimension, P, SCALE, None)

    def summary_job(self) -> DataFrame:
        return job.summary_of(self.sales, self.dimension, self.cube(), P, SCALE)

    def daily(self, grain=ROOT_GRAIN) -> DataFrame:
        """The daily table of written intervals, spread by their measured days."""
        return job.daily_table(self.saved(self.intervals(grain), "intervals"), grain)

    def bucketed_cube(self) -> DataFrame:
        shared_or_local(self.spark, tempfile.gettempdir())
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return job.save_cube(self.cube(), scratch_path(self.spark, "bucketed"), buckets)

    # --- snapshots: written balances, then the later movements alone ---------------------
    def snapshot(self, as_of: dt.date = AS_OF) -> DataFrame:
        return self.saved(S.stock_snapshot(self.movements_at(ROOT_GRAIN), ROOT_GRAIN, as_of), "snapshot")

    def since_snapshot(self, build: Callable[..., DataFrame], *more: dt.date) -> DataFrame:
        return build(self.snapshot(), self.movements_at(ROOT_GRAIN), ROOT_GRAIN, AS_OF, *more)

    # --- ledger, step by step ---------------------------------------------------------
    def net(self, grain=ROOT_GRAIN) -> DataFrame:
        return L.net_movements(self.movements_at(grain), grain)

    def running(self, grain=ROOT_GRAIN) -> DataFrame:
        return L.running_stock(self.net(grain), grain)

    def timeline(self, grain=ROOT_GRAIN) -> DataFrame:
        return L.stock_timeline(self.running(grain), grain, P.start)

    def intervals_all(self, grain=ROOT_GRAIN) -> DataFrame:
        active = L.active_timeline(self.timeline(grain), grain, P.start)
        return L.change_intervals(active, grain, P.end)

    # --- ledger, fused ----------------------------------------------------------------
    def intervals(self, grain=ROOT_GRAIN) -> DataFrame:
        return L.ledger(self.movements_at(grain), grain, P)

    # --- KPI halves ---------------------------------------------------------------------
    def revenue(self, by: str) -> DataFrame:
        return K.revenue(self.sales_enriched(), by, SCALE)

    def cost(self, by: str) -> DataFrame:
        return K.inbound_cost(self.inbounds_enriched(), by, SCALE)

    def units(self, by: str) -> DataFrame:
        return K.units_sold(self.sales_enriched(), by)

    def stock_days(self, by: str) -> DataFrame:
        return K.stock_days(self.intervals(FAMILY_GRAIN), by)

    def average(self, by: str) -> DataFrame:
        return K.average_stock(self.stock_days(by), by)


def _q(build: Callable[[Frames], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Frames(spark, sf_dir))

    query.__doc__ = build.__doc__
    return query


def _double(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.col(col).cast("double"))


def _days_in_year(f: Frames) -> DataFrame:
    """The years from the first movement (or the period's start) to the period's end."""
    first = f.movements.agg(F.greatest(F.min("Date"), P.start_lit).alias("First")).where(F.col("First") <= P.end_lit)
    years = first.select(F.explode(F.sequence(F.year("First"), F.year(P.end_lit))).alias("Year"))
    return years.select("Year", days_in_year("Year").alias("DaysInTheYear"))


def _reconcile_quantity(f: Frames) -> DataFrame:
    """One enrichment, written once; both nets come from its sums per (root, family, store, day)."""
    enriched = E.enrich(f.movements, f.dimension, ["ProductRootCode", "Family"], None)
    enriched = f.saved(enriched.select("ProductRootCode", "Family", "StoreId", "Date", "Quantity"), "enriched")
    return Q.reconcile_quantity(enriched, L.net_movements(enriched, ROOT_GRAIN), enriched, L.net_movements(enriched, FAMILY_GRAIN))


def _reconcile_days(f: Frames) -> DataFrame:
    """The intervals are built once and written; the daily rows are those of the written table."""
    intervals = f.saved(f.intervals(), "intervals")
    return Q.reconcile_days(intervals, job.daily_table(intervals, ROOT_GRAIN))


def _compare_grains(f: Frames) -> DataFrame:
    """Both ledgers from one movement cube."""
    cube = f.saved(f.cube(), "cube")
    family = L.ledger(cube.select(*FAMILY_GRAIN, "Date", "Quantity"), FAMILY_GRAIN, P)
    return Q.compare_grains(job.root_intervals(cube, P), family)


def _profile(df: DataFrame) -> DataFrame:
    """The profile to six digits: two engines sum in different orders."""
    found = Q.profile(df)
    return found.withColumns({c: F.round(c, 6) for c in ("Mean", "StdDev")})


def _written(f: Frames) -> DataFrame:
    """``interval_stock`` as it is published: written through the sink with timestamps, read again."""
    shared_or_local(f.spark, tempfile.gettempdir())
    path = f"{scratch_path(f.spark, 'published')}/interval_stock.parquet"
    write_table(job.root_intervals(f.cube(), P), path, contract=schemas.INTERVAL_STOCK)
    return f.spark.read.parquet(path).withColumns({c: F.col(c).cast("date") for c in ("StartDate", "EndDate")})


def _incremental(f: Frames) -> RetailState:
    """A state over the movements and sales up to the middle of the second year (or without a date), to which the
    later ones are added as a batch."""
    shared_or_local(f.spark, tempfile.gettempdir())
    later = F.col("Date") > F.lit(dt.date(P.end.year, 6, 30))
    rest = F.coalesce(~later, F.lit(True))
    first = Inputs(f.raw.products, f.raw.sales.where(rest), f.raw.stock_movements.where(rest))
    state = RetailState.create(f.spark, scratch_path(f.spark, "state"), first, P, SCALE)
    state.apply("later", f.raw.products, f.raw.stock_movements.where(later), f.raw.sales.where(later))
    return state


def _job_counts(f: Frames) -> DataFrame:
    """Reject counts and balances as the job takes them, in the passes that write its cube and its summary."""
    counts = job.Counts()
    movements = job.cleaned(f.raw.stock_movements, "movements", counts)
    cube = f.saved(job.movement_cube(movements, f.dimension, P, SCALE, None, counts), "cube")
    sales = job.cleaned(f.raw.sales, "sales", counts)
    f.saved(job.summary_of(sales, f.dimension, cube, P, SCALE, counts), "summary")
    rows = sorted(counts.settle().items())
    return f.spark.createDataFrame(rows, "Name string, Value bigint")


def _summary_doubles(summary: DataFrame) -> DataFrame:
    return summary.select(
        *[c for c in summary.columns if not c.endswith("Units")],
        units_to_double("RevenueUnits", SCALE).alias("Revenue"),
        units_to_double("CostUnits", SCALE).alias("Cost"),
    )


def _kpi_summary(f: Frames) -> DataFrame:
    facts = K.kpi_facts(f.sales_enriched(), f.inbounds_enriched(), f.intervals(FAMILY_GRAIN), SCALE)
    return _summary_doubles(K.kpi_summary(facts))


QUERIES: dict[str, Query] = {
    # Cleaning and quarantine
    "clean_products": _q(lambda f: f.products),
    "clean_sales": _q(lambda f: f.sales),
    "clean_movements": _q(lambda f: f.movements),
    "null_products": _q(lambda f: Q.null_rejects(f.raw.products)),
    "null_sales": _q(lambda f: Q.null_rejects(f.raw.sales)),
    "null_movements": _q(lambda f: Q.null_rejects(f.raw.stock_movements)),
    # Enrichment and period
    "enrich_movements": _q(lambda f: f.movements_at(ROOT_GRAIN)),
    "enrich_filtered": _q(lambda f: f.movements_filtered()),
    "enrich_sales": _q(lambda f: f.sales_enriched().drop("RetailPriceUnits")),
    "unmatched_sales": _q(lambda f: f.unmatched(f.sales_in_period())),
    "unmatched_movements": _q(lambda f: f.unmatched(f.inbounds_in_period())),
    "sales_in_period": _q(lambda f: f.sales_in_period()),
    "inbounds_in_period": _q(lambda f: f.inbounds_in_period()),
    # ledger
    "net_movements": _q(lambda f: f.net()),
    "running_stock": _q(lambda f: f.running()),
    "opening_stock": _q(lambda f: L.opening_stock(f.running(), ROOT_GRAIN, P.start)),
    "stock_timeline": _q(lambda f: f.timeline()),
    "pruned_stock": _q(lambda f: L.prunable_keys(f.timeline(), ROOT_GRAIN, P.start)),
    "active_stock": _q(lambda f: L.active_timeline(f.timeline(), ROOT_GRAIN, P.start)),
    "stock_intervals_all": _q(lambda f: f.intervals_all()),
    "interval_stock": _q(lambda f: f.intervals()),
    "interval_stock_steps": _q(lambda f: L.positive_intervals(f.intervals_all())),
    "interval_stock_job": _q(lambda f: job.root_intervals(f.cube(), P)),
    "nonpositive_intervals": _q(lambda f: L.nonpositive_intervals(f.intervals_all())),
    "interval_stock_family": _q(lambda f: f.intervals(FAMILY_GRAIN)),
    "net_movements_family": _q(lambda f: f.net(FAMILY_GRAIN)),
    "pruned_stock_family": _q(lambda f: L.prunable_keys(f.timeline(FAMILY_GRAIN), FAMILY_GRAIN, P.start)),
    "nonpositive_intervals_family": _q(lambda f: L.nonpositive_intervals(f.intervals_all(FAMILY_GRAIN))),
    "daily_stock": _q(lambda f: f.daily()),
    "daily_stock_family": _q(lambda f: f.daily(FAMILY_GRAIN)),
    "daily_stock_job": _q(lambda f: job.daily_table(f.saved(job.root_intervals(f.cube(), P), "intervals"), ROOT_GRAIN)),
    "interval_stock_written": _q(_written),
    "interval_stock_bucketed": _q(lambda f: job.root_intervals(f.bucketed_cube(), P, ordered=True)),
    "daily_stock_by_year": _q(lambda f: job.daily_table(f.saved(f.intervals(), "intervals"), ROOT_GRAIN, by_year=True)),
    # C6 / C7 from a written snapshot and the movements after it
    "stock_snapshot": _q(lambda f: f.snapshot()),
    "stock_snapshot_advanced": _q(lambda f: S.advance(f.snapshot(EARLIER), f.movements_at(ROOT_GRAIN), ROOT_GRAIN, EARLIER, AS_OF)),
    "running_stock_since": _q(lambda f: f.since_snapshot(S.running_since)),
    "opening_stock_since": _q(lambda f: f.since_snapshot(S.opening_since, P.start)),
    "interval_stock_since": _q(lambda f: L.ledger(f.since_snapshot(S.since), ROOT_GRAIN, P)),
    # C31 as a state to which a batch was added
    "interval_stock_incremental": _q(lambda f: _incremental(f).table("interval_stock")),
    "daily_stock_incremental": _q(lambda f: _incremental(f).table("daily_stock")),
    "kpi_summary_incremental": _q(lambda f: _summary_doubles(_incremental(f).summary())),
    # profit
    "revenue_by_family": _q(lambda f: _double(f.revenue("Family"), "Revenue")),
    "revenue_by_store": _q(lambda f: _double(f.revenue("StoreId"), "Revenue")),
    "cost_by_family": _q(lambda f: _double(f.cost("Family"), "Cost")),
    "cost_by_store": _q(lambda f: _double(f.cost("StoreId"), "Cost")),
    "family_benefits": _q(lambda f: K.profit(f.revenue("Family"), f.cost("Family"), "Family")),
    "store_benefits": _q(lambda f: K.profit(f.revenue("StoreId"), f.cost("StoreId"), "StoreId")),
    # turnover
    "units_by_family": _q(lambda f: f.units("Family")),
    "units_by_store": _q(lambda f: f.units("StoreId")),
    "stock_days_family": _q(lambda f: f.stock_days("Family")),
    "stock_days_store": _q(lambda f: f.stock_days("StoreId")),
    "days_in_year": _q(_days_in_year),
    "avg_stock_family": _q(lambda f: f.average("Family")),
    "avg_stock_store": _q(lambda f: f.average("StoreId")),
    "family_rotation": _q(lambda f: K.turnover(f.units("Family"), f.average("Family"), "Family")),
    "store_rotation": _q(lambda f: K.turnover(f.units("StoreId"), f.average("StoreId"), "StoreId")),
    # all four KPI tables in one GROUPING SETS aggregate (what the pipeline runs)
    "kpi_summary": _q(_kpi_summary),
    "kpi_summary_job": _q(lambda f: _summary_doubles(f.summary_job())),
    **{f"{name}_job": _q(lambda f, name=name: job.kpi_table(f.summary_job(), name, SCALE)) for name in job.KPI_SORT},
    # audits
    "shape_movements": _q(lambda f: Q.table_shape(f.raw.stock_movements)),
    "shape_sales": _q(lambda f: Q.table_shape(f.raw.sales)),
    "shape_products": _q(lambda f: Q.table_shape(f.raw.products)),
    "profile_sales": _q(lambda f: _profile(f.raw.sales)),
    "profile_products": _q(lambda f: _profile(f.raw.products)),
    "profile_movements": _q(lambda f: _profile(f.raw.stock_movements)),
    "duplicate_products": _q(lambda f: Q.duplicate_products(f.raw.products)),
    "date_range_movements": _q(lambda f: Q.date_range(f.raw.stock_movements)),
    "date_range_sales": _q(lambda f: Q.date_range(f.raw.sales)),
    "reconcile_quantity": _q(_reconcile_quantity),
    "reconcile_days": _q(_reconcile_days),
    "compare_grains": _q(_compare_grains),
    "job_counts": _q(_job_counts),
}
