"""The six published tables end to end.

Plan
----
1. Clean the three inputs (``isNotNull`` filters reach the Parquet scans). The clean product
   dimension gets exact LONG unit prices and is measured once; it is broadcast to both fact
   joins only when its measured size is below the bound.
2. **Movement cube**: movements up to the period end, joined to the product dimension and
   aggregated once per (ProductRootCode, Family, StoreId, Date) with the net quantity, the
   inbound cost and the number of inbound rows. Both ledgers and the inbound cost are derived
   from it, so the movements table is scanned and shuffled once. It is written to the shared
   checkpoint folder, which cuts the lineage: a lost executor costs a re-read, not a re-scan;
   bucketed by (root, store) and sorted by date, which its readers use.
3. Root-grain ledger from the cube (no exchange and no sort) -> written to the checkpoint folder, then
   published as ``interval_stock`` and densified into ``daily_stock`` (spread over a number of tasks
   computed from the measured number of output days).
4. Family-grain ledger from the cube, split by calendar year, unioned with the in-period
   sales and the cube's inbound cost, aggregated once with GROUPING SETS into a small
   summary -> the four KPI tables.
5. All tables are staged and published together. Reject counts and balances are observed in these
   passes; no table is scanned for them.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stockroom import schemas
from stockroom.config import (
    BUSINESS_PERIOD,
    DEFAULT_BROADCAST_MAX_BYTES,
    DEFAULT_PRICE_SCALE,
    FAMILY_GRAIN,
    ROOT_GRAIN,
    Period,
)
from stockroom.functions.money import price_scale_of
from stockroom.functions.nulls import any_missing
from stockroom.operators import snapshot as S
from stockroom.operators.enrich import enrich, enrich_marked, period_filter, sized_broadcast
from stockroom.operators.keyfilter import filter_bits, may_contain
from stockroom.operators.kpi import (
    benefits_from_summary,
    kpi_facts,
    kpi_summary,
    line_amount,
    rotation_from_summary,
    with_price_units,
)
from stockroom.operators.ledger import densify_by_year, densify_daily, ledger, ledger_in_order
from stockroom.operators.quality import clean
from stockroom.plans.publish import Publication
from stockroom.plans.shape import plan_counts
from stockroom.plans.snapshots import CUBE_KEYS, SnapshotStore
from stockroom.session import require_ansi, scratch_path
from stockroom.sources import bucketed, files
from stockroom.sources.files import committed
from stockroom.sources.parquet import DEFAULT_COMPRESSION, Inputs, read_inputs, write_table

KPI_SORT = {
    "store_benefits": ["Year", "StoreId"],
    "family_benefits": ["Year", "Family"],
    "store_rotation": ["Year", "StoreId"],
    "family_rotation": ["Year", "Family"],
}

DEFAULT_DAILY_ROWS_PER_TASK = 4_000_000


class Counts:
    """Numbers that the job's own passes over the data yield (``DataFrame.observe``), by name.

    A stage that Spark runs again after it lost an executor may count rows again, so numbers that must balance are
    taken anew from written tables before the job gives up on them (``run_pipeline``).
    """

    #: Seconds that the values of a finished action may take to arrive.
    PATIENCE = 60
    #: Facts that the key filter dropped; ``settle`` adds them to the unmatched ones.
    DROPPED = "dropped_"

    def __init__(self) -> None:
        self.values: dict[str, int] = {}
        self._open: list[tuple[Observation, dict[str, object]]] = []

    def observe(self, df: DataFrame, **metrics: object) -> DataFrame:
        """``df`` with ``metrics`` (name = aggregate column) taken when it is evaluated."""
        found = Observation()
        self._open.append((found, metrics))
        return df.observe(found, *[c.cast("long").alias(name) for name, c in metrics.items()])

    def settle(self) -> dict[str, int]:
        """The values of what was observed since the last call, after the action that evaluated it."""
        fresh = {}
        opened, self._open = self._open, []
        for found, metrics in opened:
            done, until = found._jo.future(), time.monotonic() + self.PATIENCE
            while not done.isCompleted() and time.monotonic() < until:  # listeners run a little behind the action
                time.sleep(0.01)
            if not done.isCompleted():
                raise RuntimeError(f"{', '.join(metrics)} were not observed")
            try:
                got = found.get
            except Py4JJavaError:  # Spark left the branch out, as it has no rows
                got = {}
            fresh |= {name: int(got.get(name) or 0) for name in metrics}
        for name in [n for n in fresh if n.startswith(self.DROPPED)]:
            fresh[f"unmatched_{name.removeprefix(self.DROPPED)}"] += fresh.pop(name)
        self.values |= fresh
        return fresh


def cleaned(raw: DataFrame, name: str, counts: Counts | None) -> DataFrame:
    """C1 and, where counted, C2: the clean rows; how many rows were read and how many had a NULL."""
    if counts is None:
        return clean(raw)
    rows = {f"{name}_rows": F.count(F.lit(1)), f"null_{name}": F.count_if(any_missing(raw))}
    return clean(counts.observe(raw, **rows))


def matched(
    fact: DataFrame,
    products: DataFrame,
    cols: list[str],
    name: str,
    scope: Column,
    counts: Counts | None,
    max_bytes: int | None = None,
    filter_bits: int | None = None,
) -> DataFrame:
    """C3 and, where counted, C4: enriched facts; how many facts within ``scope`` have no clean product. With
    ``filter_bits`` a Bloom filter of that size drops, and counts, most of these before the join."""
    if filter_bits:
        known = may_contain(fact, products, "ProductId", filter_bits)
        if counts is not None:
            fact = counts.observe(fact, **{f"{Counts.DROPPED}{name}": F.count_if(~known & scope)})
        fact = fact.where(known)
    if counts is None:
        return enrich(fact, products, cols, max_bytes)
    marked = enrich_marked(fact, products, cols, max_bytes)
    unknown = F.col(cols[0]).isNull()
    return counts.observe(marked, **{f"unmatched_{name}": F.count_if(unknown & scope)}).where(~unknown)


def inbound_in(period: Period) -> Column:
    return period.contains("Date") & (F.col("Quantity") > 0)


def movement_cube(
    movements: DataFrame,
    products: DataFrame,
    period: Period,
    price_scale: int = DEFAULT_PRICE_SCALE,
    broadcast_max_bytes: int | None = DEFAULT_BROADCAST_MAX_BYTES,
    counts: Counts | None = None,
    filter_bits: int | None = None,
) -> DataFrame:
    """Clean movements up to the period end, aggregated per (root, family, store, day).

    Quantity is the net movement (input of both ledgers); InboundCostUnits (exact LONG minor
    units of ``price_scale``) and InboundRows cover the positive movements only (input of the
    profit KPI). Returns and outbound movements never enter the cost, as the cost is summed per
    movement row before any netting. ``counts`` gets the unmatched inbound movements of the period (C4)
    and the quantity before and after the aggregation (C27).
    """
    if "SupplierPriceUnits" not in products.columns:
        products = with_price_units(products, price_scale)
    cols = ["ProductRootCode", "Family", "SupplierPriceUnits"]
    past = movements.where(F.col("Date") <= period.end_lit)
    enriched = matched(past, products, cols, "movements", inbound_in(period), counts, broadcast_max_bytes, filter_bits)
    if counts is not None:
        enriched = counts.observe(enriched, movement_quantity=F.sum("Quantity"))
    inbound = F.col("Quantity") > 0
    cube = enriched.groupBy("ProductRootCode", "Family", "StoreId", "Date").agg(
        F.sum("Quantity").cast("long").alias("Quantity"),
        F.sum(F.when(inbound, line_amount(enriched, "SupplierPrice", price_scale))).alias("InboundCostUnits"),
        F.count_if(inbound).alias("InboundRows"),
    )
    return cube if counts is None else counts.observe(cube, cube_quantity=F.sum("Quantity"))


def with_snapshot(cube: DataFrame, snapshot: DataFrame) -> DataFrame:
    """The cube of the movements after a snapshot, with the snapshot's balances as its first rows."""
    opening = S.as_movements(snapshot, CUBE_KEYS)
    return cube.unionByName(
        opening.withColumns({"InboundCostUnits": F.lit(None).cast(cube.schema["InboundCostUnits"].dataType), "InboundRows": F.lit(0).cast("long")})
    )


def priced_products(
    products: DataFrame, price_scale: int, broadcast_max_bytes: int | None = DEFAULT_BROADCAST_MAX_BYTES, unique: bool = False
) -> DataFrame:
    """The clean products as the job joins them: exact unit prices, measured once, broadcast when small. With
    ``unique`` the measuring aggregate raises if a ProductId has several rows."""
    narrow = with_price_units(products, price_scale).select(
        "ProductId", "ProductRootCode", "Family", "SupplierPriceUnits", "RetailPriceUnits"
    )
    return sized_broadcast(narrow, broadcast_max_bytes, "ProductId" if unique else None)


def save_cube(cube: DataFrame, path: str, buckets: int) -> DataFrame:
    """The cube bucketed by (root, store) and sorted by date within a key: the root ledger needs no shuffle and no
    sort, and partial sums of the family ledger are taken per bucket. A key has at most days x
    families-of-the-root rows, so a hot product is no hot bucket."""
    return bucketed.save_bucketed(cube, path, ROOT_GRAIN, [*ROOT_GRAIN, "Date"], buckets, DEFAULT_COMPRESSION)


def root_intervals(cube: DataFrame, period: Period, ordered: bool = False) -> DataFrame:
    """The published ledger from the cube. The cube holds one row per (root, family, store, day): a
    (root, store) key has at most days x families-of-the-root rows, so one hash exchange by key is safe;
    ``ordered``, for a cube of ``save_cube``, needs none."""
    rows = cube.select(*ROOT_GRAIN, "Date", "Quantity")
    return ledger_in_order(rows, ROOT_GRAIN, period) if ordered else ledger(rows, ROOT_GRAIN, period, colocate=True)


def interval_days(intervals: DataFrame) -> int:
    """The days that the intervals cover: the rows of their daily table."""
    return intervals.agg(F.sum(F.datediff("EndDate", "StartDate") + 1)).first()[0] or 0


def daily_table(
    intervals: DataFrame,
    grain: tuple[str, ...],
    rows_per_task: int = DEFAULT_DAILY_ROWS_PER_TASK,
    by_year: bool = False,
    days: int | None = None,
) -> DataFrame:
    """The daily table of written ``intervals``, over as many tasks as their measured days ask for; with a Year
    column and a year or two to a task if it is to be written ``by_year``."""
    days = interval_days(intervals) if days is None else days
    tasks = daily_task_count(days, rows_per_task, intervals.sparkSession.sparkContext.defaultParallelism)
    return densify_by_year(intervals, grain, tasks) if by_year else densify_daily(intervals, grain, partitions=tasks)


def summary_of(sales: DataFrame, products: DataFrame, cube: DataFrame, period: Period, price_scale: int, counts: Counts | None = None, filter_bits: int | None = None) -> DataFrame:
    """The KPI summary from clean sales, priced products and the movement cube. ``counts`` gets the unmatched
    sales of the period (C4)."""
    sales_e = matched(period_filter(sales, period), products, ["Family", "RetailPriceUnits"], "sales", F.lit(True), counts, None, filter_bits)
    inbound = cube.where(period.contains("Date") & (F.col("InboundRows") > 0))
    family_iv = ledger(cube.select(*FAMILY_GRAIN, "Date", "Quantity"), FAMILY_GRAIN, period)
    return kpi_summary(kpi_facts(sales_e, inbound, family_iv, price_scale))


def kpi_table(summary: DataFrame, name: str, price_scale: int) -> DataFrame:
    """One of the four published KPI tables from the summary."""
    by = "StoreId" if name.startswith("store") else "Family"
    if name.endswith("benefits"):
        return benefits_from_summary(summary, by, price_scale)
    return rotation_from_summary(summary, by)


def daily_task_count(total_rows: int, rows_per_task: int, parallelism: int) -> int:
    """Tasks for the daily table: enough that none writes more than ``rows_per_task`` rows.

    When the output fills at least one wave of ``parallelism`` tasks, the count is rounded up to
    whole waves so the last wave does not run half empty; a small output keeps its few tasks
    (no cluster-sized spray of tiny files).
    """
    tasks = max(1, math.ceil(total_rows / rows_per_task))
    slots = max(1, parallelism)
    if tasks < slots:
        return tasks
    return math.ceil(tasks / slots) * slots


def save(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and return the re-read table (lineage cut, survives executor loss)."""
    df.write.mode("overwrite").option("compression", DEFAULT_COMPRESSION).parquet(path)
    return df.sparkSession.read.parquet(path)


#: Changes whenever an intermediate table changes its meaning.
LAYOUT = 3
#: Names a folder as one of this job's scratch folders.
SCRATCH_MARKER = "_STOCKROOM_SCRATCH"
#: What a scratch folder holds besides; nothing else is ever removed from it.
SCRATCH_TABLES = ("movement_cube", "root_intervals", "kpi_summary")


def fingerprint(inputs: Inputs, period: Period, price_scale: int, **more: object) -> str:
    """What an intermediate table depends on, as text: parameters, layout version and the input files' number, bytes
    and a sum of hashes of name, size and time (or the plan, for inputs that were not read from paths)."""
    spark = inputs.products.sparkSession
    tables = files.listing(spark, inputs.paths) if inputs.paths else {}
    for name in ("products", "sales", "stock_movements"):
        df = getattr(inputs, name)
        tables.setdefault(name, [df.semanticHash()]).append(df.schema.simpleString())
    about = {"layout": LAYOUT, "period": [str(period.start), str(period.end)], "price_scale": price_scale, "inputs": tables, **more}
    return json.dumps(about, sort_keys=True)


def claim_scratch(spark: SparkSession, scratch: str) -> None:
    """Mark a new or empty folder as scratch; one that holds anything and has no marker is refused."""
    marker = f"{scratch}/{SCRATCH_MARKER}"
    if files.exists(spark, marker):
        return
    found = files.names(spark, scratch)
    if found:
        raise ValueError(f"{scratch} is no scratch folder of this job (it holds {', '.join(found[:3])}); nothing was written or removed")
    files.write_text(spark, marker, "")


def remove_scratch(spark: SparkSession, scratch: str) -> None:
    """Remove this job's tables from its scratch folder, and the folder if nothing else is in it."""
    bucketed.forget(spark, scratch)
    for name in SCRATCH_TABLES:
        for suffix in ("", ".manifest", ".counts", ".buckets"):
            files.delete(spark, f"{scratch}/{name}{suffix}")
    if files.names(spark, scratch) == [SCRATCH_MARKER]:
        files.delete(spark, f"{scratch}/{SCRATCH_MARKER}")
        files.delete_if_empty(spark, scratch)


@dataclass
class PipelineRun:
    """``counts``: rows read and rejected (C2, C4) and the balances (C27, C28), from the job's own passes.
    ``snapshot``: the day whose balances the run started from, if any."""

    out_dir: str
    scratch_dir: str
    seconds: dict[str, float] = field(default_factory=dict)
    reused: list[str] = field(default_factory=list)
    plans: dict[str, dict[str, int]] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)
    snapshot: str | None = None


def run_pipeline(
    spark: SparkSession,
    out_dir: str,
    in_dir: str | None = None,
    inputs: Inputs | None = None,
    period: Period = BUSINESS_PERIOD,
    timestamp_output: bool = True,
    price_scale: int | None = None,
    broadcast_max_bytes: int | None = DEFAULT_BROADCAST_MAX_BYTES,
    daily_rows_per_task: int = DEFAULT_DAILY_ROWS_PER_TASK,
    tables: tuple[str, ...] | None = None,
    on_step: Callable[[str, float], None] | None = None,
    scratch_dir: str | None = None,
    record_plans: bool = False,
    keep_scratch: bool = False,
    daily_by_year: bool = False,
    layout: str = "flat",
    counted: bool = True,
    allow_duplicate_products: bool = False,
    cube_buckets: int | None = None,
    snapshot_dir: str | None = None,
    late: str = "raise",
    filter_facts: bool = False,
) -> PipelineRun:
    """Compute the six tables and publish them below ``out_dir`` as one version; returns the seconds of each step.

    The tables are staged and become current together when all are complete, in the ``layout`` "flat"
    (``<out>/<table>.parquet``) or "versions" (a pointer file; see ``plans.publish``). A run that fails leaves what was
    published before. ``tables`` restricts the published outputs (all six by default).

    Intermediate tables go to a fresh folder below the session's ``spark.checkpoint.dir``, which is
    removed when all tables are written (``keep_scratch`` keeps it). ``price_scale`` is the number of decimals that a
    price may have; by default that of DECIMAL prices, at least 2. ``daily_by_year`` writes ``daily_stock`` in folders
    ``Year=...``. The movement cube has ``cube_buckets`` buckets (default: the session's shuffle partitions).

    ``counted`` takes reject counts and balances in the passes that the job makes anyway (``PipelineRun.counts``);
    without it, date filters reach the scans of the fact tables. A ProductId with several clean rows stops the job
    unless ``allow_duplicate_products``: each of its facts would count several times.

    ``filter_facts`` drops most facts of unknown products by a Bloom filter of the clean ProductIds before the product
    joins, for products above the broadcast bound; results and counts stay the same.

    ``snapshot_dir`` keeps balances of period ends (``plans.snapshots``): the run starts from the latest that is before
    ``period.start``, reads only movements after it, and adds that of ``period.end``. ``late`` says what happens when movements that a snapshot
    covers have changed or arrived since: "raise", "rebuild" (the snapshot is not used) or "ignore" (not checked).

    ``scratch_dir`` resumes an interrupted run of the *same* job: pass the ``scratch_dir`` of the failed
    run and every intermediate table whose write was committed there is read back instead of recomputed
    (listed in ``PipelineRun.reused``). A manifest beside each table holds the parameters and input files
    it was made from; any difference raises, and so does a folder that is no scratch folder of this job. Executor loss
    needs none of this (Spark re-runs the lost tasks); it is for a lost driver.

    ``record_plans`` stores the shuffle/sort/window counts of each step's physical plan in
    ``PipelineRun.plans``.
    """
    if inputs is None:
        if in_dir is None:
            raise ValueError("give in_dir or inputs")
        inputs = read_inputs(spark, in_dir)
    require_ansi(spark)
    if price_scale is None:
        price_scale = price_scale_of(inputs.products)
    wanted = set(tables or ("interval_stock", "daily_stock", *KPI_SORT))
    scratch = scratch_dir.rstrip("/") if scratch_dir else scratch_path(spark, "pipeline")
    claim_scratch(spark, scratch)
    publication = Publication(spark, out_dir, layout)
    run = PipelineRun(out_dir=publication.out, scratch_dir=scratch)
    counts = Counts() if counted else None
    made_from: list[str] = []

    def manifest() -> str:
        if not made_from:
            made_from.append(fingerprint(inputs, period, price_scale, counted=counted, snapshot=run.snapshot))
        return made_from[0]

    def shape(name: str, df: DataFrame) -> DataFrame:
        if record_plans:
            run.plans[name] = plan_counts(df)
        return df

    def settle(name: str | None = None) -> None:
        if counts is not None:
            fresh = counts.settle()
            run.counts |= fresh
            if name:
                files.write_text(spark, f"{scratch}/{name}.counts", json.dumps(fresh))

    def saved(
        name: str,
        build: Callable[[], DataFrame],
        write: Callable[[DataFrame, str], DataFrame] = save,
        load: Callable[[SparkSession, str], DataFrame] = lambda s, p: s.read.parquet(p),
    ) -> DataFrame:
        path = f"{scratch}/{name}"
        if scratch_dir and committed(spark, path):
            known = files.read_text(spark, f"{path}.manifest") or "no manifest"
            if known != manifest():
                raise ValueError(f"{path} was made from other inputs or parameters: {known}; this run has {manifest()}")
            run.reused.append(name)
            run.counts |= files.read_json(spark, f"{path}.counts") or {}
            return load(spark, path)
        # the manifest first: a committed table always has one
        files.write_text(spark, f"{path}.manifest", manifest())
        table = write(shape(name, build()), path)
        settle(name)
        return table

    def step(name: str, action: Callable[[], object]) -> object:
        t0 = time.perf_counter()
        result = action()
        run.seconds[name] = time.perf_counter() - t0
        if on_step:
            on_step(name, run.seconds[name])
        return result

    def balanced(what: str, left: str, right: str, again: Callable[[], tuple[int, int]]) -> None:
        """Both counts are equal, or at least the written tables are."""
        if counts is not None and run.counts.get(left) != run.counts.get(right):
            run.counts[left], run.counts[right] = again()
            if run.counts[left] != run.counts[right]:
                raise RuntimeError(f"{what} does not balance: {left} {run.counts[left]}, {right} {run.counts[right]}")

    # The clean product dimension, with exact unit prices, measured once and broadcast to both
    # fact joins when small enough (the broadcast hint survives the per-join column selection).
    def dimension() -> DataFrame:
        raw = inputs.products
        if counts is not None:
            raw = counts.observe(raw, products_rows=F.count(F.lit(1)), null_products=F.count_if(any_missing(raw)))
        found = priced_products(clean(raw), price_scale, broadcast_max_bytes, not allow_duplicate_products)
        if counts is not None and (broadcast_max_bytes is not None or not allow_duplicate_products):
            settle()
        return found

    products = step("product_dimension", dimension)
    bits = filter_bits(products.count()) if filter_facts else None
    movements = inputs.stock_movements
    store = base = None
    if snapshot_dir:
        store = SnapshotStore(spark, snapshot_dir, products)
        base = step("snapshot", lambda: store.usable(movements, period.start, late))
        if base:
            run.snapshot = str(base.as_of)
            # a row without a date is a reject, whatever the day
            movements = movements.where((F.col("Date") > F.lit(base.as_of)) | F.col("Date").isNull())

    def cube_of() -> DataFrame:
        cube = movement_cube(cleaned(movements, "movements", counts), products, period, price_scale, None, counts, bits)
        return with_snapshot(cube, base.balances()) if base else cube

    buckets = cube_buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cube = step(
        "movement_cube",
        lambda: saved("movement_cube", cube_of, lambda df, path: save_cube(df, path, buckets), bucketed.load_bucketed),
    )

    def quantities() -> tuple[int, int]:
        rows = enrich(clean(inputs.stock_movements).where(F.col("Date") <= period.end_lit), products, ["ProductRootCode"], None)
        return tuple(df.agg(F.sum("Quantity")).first()[0] or 0 for df in (rows, cube))

    balanced("the movement cube (C27)", "movement_quantity", "cube_quantity", quantities)

    if wanted & {"interval_stock", "daily_stock"}:
        root_iv = step(
            "root_intervals",
            lambda: saved("root_intervals", lambda: root_intervals(cube, period, ordered=True)),
        )
        if "interval_stock" in wanted:
            step(
                "interval_stock",
                lambda: write_table(
                    shape("interval_stock", root_iv),
                    publication.path("interval_stock"),
                    timestamp_output,
                    contract=schemas.INTERVAL_STOCK,
                ),
            )
        if "daily_stock" in wanted:

            def write_daily() -> None:
                days = interval_days(root_iv)
                daily = daily_table(root_iv, ROOT_GRAIN, daily_rows_per_task, daily_by_year, days)
                shape("daily_stock", daily)
                if counts is not None:
                    run.counts["interval_days"] = days
                    daily = counts.observe(daily, daily_rows=F.count(F.lit(1)))
                write_table(
                    daily,
                    publication.path("daily_stock"),
                    timestamp_output,
                    contract=schemas.DAILY_STOCK,
                    by_year=daily_by_year,
                )
                settle()
                balanced("daily_stock (C28)", "interval_days", "daily_rows", lambda: (days, spark.read.parquet(publication.path("daily_stock")).count()))

            step("daily_stock", write_daily)

    kpis = wanted & set(KPI_SORT)
    if kpis:

        def summary() -> DataFrame:
            return summary_of(cleaned(inputs.sales, "sales", counts), products, cube, period, price_scale, counts, bits)

        summary = step("kpi_summary", lambda build=summary: saved("kpi_summary", build))
        for name in sorted(kpis):
            table = kpi_table(summary, name, price_scale)
            step(
                name,
                lambda t=table, n=name: write_table(
                    shape(n, t),
                    publication.path(n),
                    timestamp_output,
                    sort_by=KPI_SORT[n],
                    partitions=1,
                    contract=schemas.OUTPUTS[n],
                ),
            )
    publication.commit(period=[str(period.start), str(period.end)], counts=run.counts)
    if store:
        step("save_snapshot", lambda: store.save(cube, inputs.stock_movements, period.end))
    if not keep_scratch:
        remove_scratch(spark, scratch)
    else:
        bucketed.forget(spark, scratch)
    return run
