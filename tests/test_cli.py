"""The command line end to end, in its own process, as a user runs it."""

from __future__ import annotations

import json
import os
import subprocess
import sys
import tempfile

from conftest import ROOT, SF_SMALL

from stockroom import schemas
from stockroom.sources import write_inputs


def test_cli_writes_the_six_tables(spark):
    in_dir = tempfile.mkdtemp(prefix="stockroom-in-")
    out_dir = tempfile.mkdtemp(prefix="stockroom-out-")
    write_inputs(spark, SF_SMALL, in_dir)
    cmd = [sys.executable, "-m", "stockroom", "--in", in_dir, "--out", out_dir, "--start", "1999-01-01", "--end", "2000-12-31", "--price-scale", "3"]
    done = subprocess.run(cmd, cwd=ROOT, capture_output=True, text=True, timeout=600, env={**os.environ, "PYTHONPATH": ROOT})
    assert done.returncode == 0, done.stderr[-2000:]
    report = json.loads(done.stdout.strip().splitlines()[-1])
    assert report["reused"] == [] and set(report["seconds"]) >= set(schemas.OUTPUTS)
    tables = sorted(n for n in os.listdir(out_dir) if n.endswith(".parquet"))
    assert tables == sorted(f"{name}.parquet" for name in schemas.OUTPUTS)
    assert spark.read.parquet(f"{out_dir}/interval_stock.parquet").count() == 1036
