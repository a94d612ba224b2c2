"""Write PLANS.md: the physical plan of every step of the job, with its shuffle/sort/window counts.

    python tools/dump_plans.py [/root/testdata/sf0.01]

The plans are built exactly as ``run_pipeline`` builds them (reading the saved movement cube
and root intervals), so the file shows what runs on a cluster.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from stockroom.config import FAMILY_GRAIN, FIXTURE_PERIOD, FIXTURE_PRICE_SCALE, ROOT_GRAIN  # noqa: E402
from stockroom.operators import (  # noqa: E402
    benefits_from_summary,
    clean,
    densify_daily,
    enrich,
    kpi_facts,
    kpi_summary,
    ledger,
    period_filter,
    sized_broadcast,
    with_price_units,
)
from stockroom.plans import movement_cube, plan_counts, plan_text, save  # noqa: E402
from stockroom.plans.pipeline import root_intervals, save_cube  # noqa: E402
from stockroom.session import build_session, ensure_checkpoint_dir  # noqa: E402
from stockroom.sources import read_inputs, write_inputs  # noqa: E402

_IDS = re.compile(r"#\d+L?")
_PLAN_ID = re.compile(r", \[plan_id=\d+\]")


def _tidy(text: str, width: int = 180) -> str:
    physical = text.split("== Physical Plan ==")[-1].strip("\n")
    lines = []
    for line in physical.splitlines():
        line = _PLAN_ID.sub("", _IDS.sub("", line))
        lines.append(line if len(line) <= width else line[: width - 3] + "...")
    return "\n".join(lines)


def main(sf_dir: str) -> None:
    P = FIXTURE_PERIOD
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = build_session("local[8]", app_name="stockroom-plans", shuffle_partitions=16)
    ensure_checkpoint_dir(spark, f"{scratch}/checkpoints")
    write_inputs(spark, sf_dir, f"{scratch}/in")
    inputs = read_inputs(spark, f"{scratch}/in")
    products = sized_broadcast(
        with_price_units(clean(inputs.products), FIXTURE_PRICE_SCALE).select(
            "ProductId", "ProductRootCode", "Family", "SupplierPriceUnits", "RetailPriceUnits"
        )
    )
    sales, movements = clean(inputs.sales), clean(inputs.stock_movements)

    cube_df = movement_cube(movements, products, P, FIXTURE_PRICE_SCALE, None)
    cube = save_cube(cube_df, f"{scratch}/cube", 16)
    root_df = root_intervals(cube, P, ordered=True)
    root = save(root_df, f"{scratch}/root")
    daily = densify_daily(root, ROOT_GRAIN, partitions=32)
    sales_e = enrich(period_filter(sales, P), products, ["Family", "RetailPriceUnits"], None)
    inbound = cube.where(P.contains("Date") & (F.col("InboundRows") > 0))
    family_iv = ledger(cube.select(*FAMILY_GRAIN, "Date", "Quantity"), FAMILY_GRAIN, P)
    summary_df = kpi_summary(kpi_facts(sales_e, inbound, family_iv, FIXTURE_PRICE_SCALE))
    summary = save(summary_df, f"{scratch}/summary")

    steps = [
        ("movement_cube", "Scan movements (pushed `Date <= end`, not-null filters), broadcast-join the "
         "priced product slice, partial sum per map task, one exchange, final sum. (The counting job reads all rows, "
         "joins with a left join and observes rejects on the way.)", cube_df),
        ("root_intervals", "Read the saved cube, bucketed by (ProductRootCode, StoreId) and sorted by date: running sum and "
         "`lead` in one Window node, no exchange and no sort.", root_df),
        ("daily_stock", "Hash the saved intervals by key into a measured number of tasks, sort the intervals "
         "(not the output) by key and start inside each task, then a narrow `explode(sequence)`: the daily "
         "rows come out clustered by (key, Date).", daily),
        ("kpi_summary", "Sales (pushed period and `Quantity > 0`, broadcast join), the cube's inbound cost and "
         "the family ledger's year-split stock-days, unioned, summed per (Year, StoreId, Family) and that small result aggregated with GROUPING SETS.", summary_df),
        ("store_benefits", "A projection of the saved summary.", benefits_from_summary(summary, "StoreId", FIXTURE_PRICE_SCALE)),
    ]
    out = [
        "# Physical plans of the job",
        "",
        f"Generated by `tools/dump_plans.py` on `{sf_dir}` (fixture inputs, period {P.start} .. {P.end}), "
        "Spark local[8], AQE on (plans shown before AQE re-planning). Expression ids removed.",
        "",
        "| step | shuffle exchanges | broadcasts | sorts | windows | hash aggregates |",
        "| --- | --- | --- | --- | --- | --- |",
    ]
    for name, _, df in steps:
        c = plan_counts(df)
        out.append(
            f"| {name} | {c['Exchange']} | {c['BroadcastExchange']} | {c['Sort']} | {c['Window']} | {c['HashAggregate']} |"
        )
    for name, what, df in steps:
        out += ["", f"## {name}", "", what, "", "```", _tidy(plan_text(df)), "```"]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out) + "\n")
    print(path)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
