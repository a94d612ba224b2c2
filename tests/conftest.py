from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from stockroom import schemas  # noqa: E402
from stockroom.session import build_session, ensure_checkpoint_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", app_name="stockroom-tests", shuffle_partitions=8)
    ensure_checkpoint_dir(session, tempfile.mkdtemp(prefix="stockroom-ckpt-"))
    yield session


@pytest.fixture()
def out_dir():
    return tempfile.mkdtemp(prefix="stockroom-out-")


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def make_products(spark, rows):
    """rows: (ProductRootCode, ProductId, SupplierPrice, RetailPrice, Family)."""
    return spark.createDataFrame(rows, schemas.PRODUCTS)


def make_facts(spark, rows, schema=schemas.STOCK_MOVEMENTS):
    """rows: (StoreId, ProductId, 'YYYY-MM-DD' or date, Quantity)."""
    fixed = [(s, p, d(x) if isinstance(x, str) else x, q) for s, p, x, q in rows]
    return spark.createDataFrame(fixed, schema)


def collect_sorted(df, cols=None):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
