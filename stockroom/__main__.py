"""Command line: compute the six tables from the three input tables.

    spark-submit -m stockroom --in <dir with products/sales/stock_movements.parquet> --out <dir>
    python -m stockroom --in dat --out res --start 2019-01-01 --end 2020-12-31

On a cluster the session comes from spark-submit and ``spark.checkpoint.dir`` must name a
shared folder; only with a local master a folder below ``--out`` is used when none is set.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from stockroom.config import BUSINESS_PERIOD, Period
from stockroom.plans.pipeline import DEFAULT_DAILY_ROWS_PER_TASK, KPI_SORT, run_pipeline
from stockroom.plans.publish import LAYOUTS
from stockroom.plans.snapshots import LATE
from stockroom.session import RECOMMENDED_CONF, shared_or_local


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="stockroom", description=__doc__.splitlines()[0])
    ap.add_argument("--in", dest="in_dir", required=True, help="folder with the three input Parquet tables")
    ap.add_argument("--out", dest="out_dir", required=True, help="folder for the six output tables")
    ap.add_argument("--start", default=BUSINESS_PERIOD.start.isoformat())
    ap.add_argument("--end", default=BUSINESS_PERIOD.end.isoformat())
    ap.add_argument("--date-output", action="store_true", help="write DATE columns instead of timestamps")
    ap.add_argument("--tables", nargs="*", choices=["interval_stock", "daily_stock", *KPI_SORT])
    ap.add_argument("--daily-rows-per-task", type=int, default=DEFAULT_DAILY_ROWS_PER_TASK)
    ap.add_argument("--price-scale", type=int, help="decimals that a price may have (default: those of DECIMAL prices, at least 2)")
    ap.add_argument("--daily-by-year", action="store_true", help="write daily_stock in folders Year=...")
    ap.add_argument("--keep-scratch", action="store_true", help="keep the intermediate tables")
    ap.add_argument("--resume", metavar="SCRATCH_DIR", help="scratch_dir of an interrupted run of the same job")
    ap.add_argument("--layout", choices=LAYOUTS, default="flat", help="<out>/<table>.parquet, or versions behind a pointer file")
    ap.add_argument("--snapshots", metavar="DIR", help="folder of stock balances to start from and to add to")
    ap.add_argument("--late", choices=LATE, default="raise", help="what to do when movements that a snapshot covers have changed")
    ap.add_argument("--uncounted", action="store_true", help="no reject counts; date filters reach the scans of the facts")
    ap.add_argument("--allow-duplicate-products", action="store_true", help="count a fact once per row of its ProductId")
    ap.add_argument("--filter-facts", action="store_true", help="Bloom filter of the products before their joins, where they are too many to broadcast")
    args = ap.parse_args(argv)

    builder = SparkSession.builder.appName("stockroom")
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    shared_or_local(spark, f"{args.out_dir.rstrip('/')}/_checkpoints")
    run = run_pipeline(
        spark,
        args.out_dir,
        in_dir=args.in_dir,
        period=Period.of(args.start, args.end),
        timestamp_output=not args.date_output,
        tables=tuple(args.tables) if args.tables else None,
        daily_rows_per_task=args.daily_rows_per_task,
        scratch_dir=args.resume,
        price_scale=args.price_scale,
        daily_by_year=args.daily_by_year,
        keep_scratch=args.keep_scratch,
        layout=args.layout,
        snapshot_dir=args.snapshots,
        late=args.late,
        counted=not args.uncounted,
        allow_duplicate_products=args.allow_duplicate_products,
        filter_facts=args.filter_facts,
    )
    print(
        json.dumps(
            {
                "out_dir": run.out_dir,
                "scratch_dir": run.scratch_dir,
                "reused": run.reused,
                "snapshot": run.snapshot,
                "counts": run.counts,
                "seconds": {k: round(v, 3) for k, v in run.seconds.items()},
            }
        )
    )


if __name__ == "__main__":
    main()
