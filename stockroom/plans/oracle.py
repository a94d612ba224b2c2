"""Independent SQL statement of every catalog query, for DuckDB over the raw test tables.

The SQL follows the business rules step by step (opening balance and later changes as two
branches joined by UNION ALL, key flags, LEAD over the change rows, per-day explosion for
the stock-days) rather than the fused Spark plans, so a match checks the fused plans against
the plain definition. Tables ``part`` and ``lineitem`` are read whole.

DuckDB notes: SUM of integers is HUGEINT and year() is BIGINT, hence the casts; ``x / 0`` is
``inf`` in DuckDB, hence NULLIF for the NULL-on-zero division.
"""

from __future__ import annotations

from stockroom.config import FIXTURE_PERIOD

AS_OF = f"CAST(DATE '{FIXTURE_PERIOD.start.isoformat()}' - 1 AS DATE)"
START = f"DATE '{FIXTURE_PERIOD.start.isoformat()}'"
END = f"DATE '{FIXTURE_PERIOD.end.isoformat()}'"


def _ledger_ctes(g: str, k: str) -> str:
    """CTEs {g}_mov .. {g}_daily for the ledger keyed by ({k}, StoreId)."""
    key = f"{k}, StoreId"
    return f"""
{g}_mov AS (
  SELECT m.ProductId, m.StoreId, m."Date", m.Quantity, p.{k}
  FROM m_clean m JOIN p_clean p ON m.ProductId = p.ProductId),
{g}_net AS (
  SELECT {key}, "Date", CAST(SUM(Quantity) AS BIGINT) AS Quantity FROM {g}_mov GROUP BY {key}, "Date"),
{g}_run AS (
  SELECT {key}, "Date", Quantity,
         CAST(SUM(Quantity) OVER (PARTITION BY {key} ORDER BY "Date"
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS Stock
  FROM {g}_net),
{g}_open AS (
  SELECT {key}, {START} AS "Date", Stock
  FROM (SELECT *, MAX("Date") OVER (PARTITION BY {key}) AS last_day FROM {g}_run WHERE "Date" <= {START}) o
  WHERE "Date" = last_day),
{g}_later AS (SELECT {key}, "Date", Stock FROM {g}_run WHERE "Date" > {START}),
{g}_tl AS (SELECT * FROM {g}_open UNION ALL SELECT * FROM {g}_later),
{g}_flags AS (
  SELECT *, COUNT(*) OVER (PARTITION BY {key}) AS n_rows,
         SUM(CASE WHEN Stock >= 0 THEN 1 ELSE 0 END) OVER (PARTITION BY {key}) AS n_non_negative
  FROM {g}_tl),
{g}_active AS (
  SELECT {key}, "Date", Stock FROM {g}_flags
  WHERE NOT ((n_rows = 1 AND Stock = 0 AND "Date" = {START}) OR n_non_negative = 0)),
{g}_iv_all AS (
  SELECT {key}, "Date" AS StartDate,
         COALESCE(CAST(LEAD("Date") OVER (PARTITION BY {key} ORDER BY "Date") - 1 AS DATE), {END}) AS EndDate,
         Stock
  FROM {g}_active WHERE "Date" <= {END}),
{g}_iv AS (SELECT * FROM {g}_iv_all WHERE Stock > 0),
{g}_days AS (
  SELECT {key}, unnest(generate_series(CAST(StartDate AS TIMESTAMP), CAST(EndDate AS TIMESTAMP), INTERVAL 1 DAY)) AS ts,
         Stock
  FROM {g}_iv),
{g}_daily AS (SELECT {key}, CAST(ts AS DATE) AS "Date", Stock FROM {g}_days)"""


_SNAPSHOT = f"""
SELECT ProductRootCode, StoreId, {AS_OF} AS AsOf, CAST(SUM(Quantity) AS BIGINT) AS Stock
FROM r_mov WHERE "Date" <= {AS_OF} GROUP BY ProductRootCode, StoreId"""

PRELUDE = f"""
WITH
products AS (
  SELECT CAST(floor(p_partkey / 4) AS INTEGER) AS ProductRootCode,
         CAST(p_partkey AS INTEGER) AS ProductId,
         CAST(p_retailprice * 0.5 AS FLOAT) AS SupplierPrice,
         CAST(CASE WHEN p_partkey % 50 = 7 THEN NULL ELSE p_retailprice END AS FLOAT) AS RetailPrice,
         p_type AS Family
  FROM part),
sales AS (
  SELECT CAST(l_suppkey AS INTEGER) AS StoreId, CAST(CASE WHEN l_partkey % 40 = 11 THEN -l_partkey ELSE l_partkey END AS INTEGER) AS ProductId,
         CAST(l_shipdate AS DATE) AS "Date",
         CAST(CASE WHEN l_orderkey % 997 = 0 THEN NULL WHEN l_returnflag = 'R' OR l_suppkey % 10 = 3 THEN -l_quantity
                   ELSE l_quantity END AS INTEGER) AS Quantity
  FROM lineitem),
stock_movements AS (
  SELECT CAST(l_suppkey AS INTEGER) AS StoreId, CAST(CASE WHEN l_partkey % 40 = 11 THEN -l_partkey ELSE l_partkey END AS INTEGER) AS ProductId,
         CASE WHEN l_orderkey % 991 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS "Date",
         CAST(CASE WHEN l_suppkey % 10 = 4 THEN -l_quantity
                   WHEN l_suppkey % 10 = 5 AND l_shipdate <= TIMESTAMP '1999-01-01 00:00:00' THEN 0
                   WHEN l_linestatus = 'F' THEN l_quantity ELSE -l_quantity END AS INTEGER) AS Quantity
  FROM lineitem),
p_clean AS (
  SELECT * FROM products
  WHERE ProductRootCode IS NOT NULL AND ProductId IS NOT NULL AND Family IS NOT NULL
    AND SupplierPrice IS NOT NULL AND NOT isnan(SupplierPrice)
    AND RetailPrice IS NOT NULL AND NOT isnan(RetailPrice)),
s_clean AS (
  SELECT * FROM sales
  WHERE StoreId IS NOT NULL AND ProductId IS NOT NULL AND "Date" IS NOT NULL AND Quantity IS NOT NULL),
m_clean AS (
  SELECT * FROM stock_movements
  WHERE StoreId IS NOT NULL AND ProductId IS NOT NULL AND "Date" IS NOT NULL AND Quantity IS NOT NULL),
s_period AS (SELECT * FROM s_clean WHERE "Date" BETWEEN {START} AND {END} AND Quantity > 0),
m_period AS (SELECT * FROM m_clean WHERE "Date" BETWEEN {START} AND {END} AND Quantity > 0),
s_enriched AS (
  SELECT s.ProductId, s.StoreId, s."Date", s.Quantity, p.Family, p.RetailPrice
  FROM s_period s JOIN p_clean p ON s.ProductId = p.ProductId),
m_inbound AS (
  SELECT m.ProductId, m.StoreId, m."Date", m.Quantity, p.Family, p.SupplierPrice
  FROM m_period m JOIN p_clean p ON m.ProductId = p.ProductId),
{_ledger_ctes("r", "ProductRootCode")},
{_ledger_ctes("f", "Family")},
rev_family AS (
  SELECT CAST(year("Date") AS INTEGER) AS "Year", Family,
         SUM(Quantity * CAST(RetailPrice AS DECIMAL(14,3))) AS Revenue FROM s_enriched GROUP BY 1, 2),
rev_store AS (
  SELECT CAST(year("Date") AS INTEGER) AS "Year", StoreId,
         SUM(Quantity * CAST(RetailPrice AS DECIMAL(14,3))) AS Revenue FROM s_enriched GROUP BY 1, 2),
cost_family AS (
  SELECT CAST(year("Date") AS INTEGER) AS "Year", Family,
         SUM(Quantity * CAST(SupplierPrice AS DECIMAL(14,3))) AS Cost FROM m_inbound GROUP BY 1, 2),
cost_store AS (
  SELECT CAST(year("Date") AS INTEGER) AS "Year", StoreId,
         SUM(Quantity * CAST(SupplierPrice AS DECIMAL(14,3))) AS Cost FROM m_inbound GROUP BY 1, 2),
units_family AS (
  SELECT CAST(year("Date") AS INTEGER) AS "Year", Family, CAST(SUM(Quantity) AS BIGINT) AS UnitsSold
  FROM s_enriched GROUP BY 1, 2),
units_store AS (
  SELECT CAST(year("Date") AS INTEGER) AS "Year", StoreId, CAST(SUM(Quantity) AS BIGINT) AS UnitsSold
  FROM s_enriched GROUP BY 1, 2),
sd_family AS (
  SELECT CAST(year("Date") AS INTEGER) AS "Year", Family, CAST(SUM(Stock) AS BIGINT) AS SumStock
  FROM f_daily GROUP BY 1, 2),
sd_store AS (
  SELECT CAST(year("Date") AS INTEGER) AS "Year", StoreId, CAST(SUM(Stock) AS BIGINT) AS SumStock
  FROM f_daily GROUP BY 1, 2),
avg_family AS (
  SELECT "Year", Family,
         SumStock / CAST(CASE WHEN ("Year" % 4 = 0 AND "Year" % 100 <> 0) OR "Year" % 400 = 0
                              THEN 366 ELSE 365 END AS DOUBLE) AS AverageStock
  FROM sd_family),
avg_store AS (
  SELECT "Year", StoreId,
         SumStock / CAST(CASE WHEN ("Year" % 4 = 0 AND "Year" % 100 <> 0) OR "Year" % 400 = 0
                              THEN 366 ELSE 365 END AS DOUBLE) AS AverageStock
  FROM sd_store)
"""


def _profit(by: str, suffix: str) -> str:
    return f"""
SELECT COALESCE(r."Year", c."Year") AS "Year", COALESCE(r.{by}, c.{by}) AS {by},
       CAST(COALESCE(r.Revenue, 0) - COALESCE(c.Cost, 0) AS DOUBLE) AS Profit
FROM rev_{suffix} r FULL OUTER JOIN cost_{suffix} c ON r."Year" = c."Year" AND r.{by} = c.{by}"""


def _turnover(by: str, suffix: str) -> str:
    return f"""
SELECT COALESCE(u."Year", a."Year") AS "Year", COALESCE(u.{by}, a.{by}) AS {by},
       CAST(COALESCE(u.UnitsSold, 0) AS DOUBLE) / NULLIF(COALESCE(a.AverageStock, 0), 0) AS Turnover
FROM units_{suffix} u FULL OUTER JOIN avg_{suffix} a ON u."Year" = a."Year" AND u.{by} = a.{by}"""


def _nulls(table: str, cols: list[str], floats: list[str]) -> str:
    terms = [f'"{c}" IS NULL' for c in cols] + [f'isnan("{c}")' for c in floats]
    return f"SELECT * FROM {table} WHERE " + " OR ".join(terms)


def _profile(table: str, numeric: list[str], text: list[str] = ()) -> str:
    parts = [
        f"""SELECT '{c}' AS "Column", COUNT({c}) AS "Count",
       ROUND(AVG(CAST({c} AS DOUBLE)), 6) AS Mean, ROUND(STDDEV_SAMP(CAST({c} AS DOUBLE)), 6) AS StdDev,
       CAST(MIN({c}) AS DOUBLE) AS "Min", CAST(MAX({c}) AS DOUBLE) AS "Max",
       CAST(NULL AS VARCHAR) AS MinText, CAST(NULL AS VARCHAR) AS MaxText FROM {table}"""
        for c in numeric
    ] + [
        f"""SELECT '{c}' AS "Column", COUNT({c}) AS "Count",
       CAST(NULL AS DOUBLE) AS Mean, CAST(NULL AS DOUBLE) AS StdDev,
       CAST(NULL AS DOUBLE) AS "Min", CAST(NULL AS DOUBLE) AS "Max",
       MIN({c}) AS MinText, MAX({c}) AS MaxText FROM {table}"""
        for c in text
    ]
    return "\nUNION ALL\n".join(parts)


_KPI_FACTS = """
kpi_facts AS (
  SELECT CAST(year("Date") AS INTEGER) AS "Year", StoreId, Family,
         Quantity * CAST(RetailPrice AS DECIMAL(14,3)) AS Revenue, NULL AS Cost,
         CAST(Quantity AS BIGINT) AS UnitsSold, NULL AS StockDays, 1 AS SalesRows, NULL AS CostRows, NULL AS StockRows
  FROM s_enriched
  UNION ALL
  SELECT CAST(year("Date") AS INTEGER), StoreId, Family, NULL, Quantity * CAST(SupplierPrice AS DECIMAL(14,3)),
         NULL, NULL, NULL, 1, NULL
  FROM m_inbound
  UNION ALL
  SELECT CAST(year("Date") AS INTEGER), StoreId, Family, NULL, NULL, NULL, Stock, NULL, NULL, 1
  FROM f_daily)
"""

_BODIES: dict[str, str] = {
    "clean_products": "SELECT * FROM p_clean",
    "clean_sales": "SELECT * FROM s_clean",
    "clean_movements": "SELECT * FROM m_clean",
    "null_products": _nulls(
        "products", ["ProductRootCode", "ProductId", "SupplierPrice", "RetailPrice", "Family"], ["SupplierPrice", "RetailPrice"]
    ),
    "null_sales": _nulls("sales", ["StoreId", "ProductId", "Date", "Quantity"], []),
    "null_movements": _nulls("stock_movements", ["StoreId", "ProductId", "Date", "Quantity"], []),
    "enrich_movements": "SELECT ProductId, StoreId, \"Date\", Quantity, ProductRootCode FROM r_mov",
    "enrich_filtered": "SELECT ProductId, StoreId, \"Date\", Quantity, ProductRootCode FROM r_mov",
    "enrich_sales": "SELECT * FROM s_enriched",
    "unmatched_sales": "SELECT * FROM s_period s WHERE NOT EXISTS (SELECT 1 FROM p_clean p WHERE p.ProductId = s.ProductId)",
    "unmatched_movements": (
        "SELECT * FROM m_period m WHERE NOT EXISTS (SELECT 1 FROM p_clean p WHERE p.ProductId = m.ProductId)"
    ),
    "sales_in_period": "SELECT * FROM s_period",
    "inbounds_in_period": "SELECT * FROM m_period",
    "net_movements": "SELECT * FROM r_net",
    "running_stock": "SELECT * FROM r_run",
    "opening_stock": "SELECT * FROM r_open",
    "stock_timeline": "SELECT * FROM r_tl",
    "pruned_stock": f"""
SELECT ProductRootCode, StoreId, "Date", Stock,
       CASE WHEN n_rows = 1 AND Stock = 0 AND "Date" = {START} THEN 'lone_zero_opening' ELSE 'all_negative' END AS Reason
FROM r_flags WHERE (n_rows = 1 AND Stock = 0 AND "Date" = {START}) OR n_non_negative = 0""",
    "active_stock": "SELECT * FROM r_active",
    "stock_intervals_all": "SELECT * FROM r_iv_all",
    "interval_stock": "SELECT * FROM r_iv",
    "interval_stock_steps": "SELECT * FROM r_iv",
    "interval_stock_job": "SELECT * FROM r_iv",
    "interval_stock_bucketed": "SELECT * FROM r_iv",
    "interval_stock_since": "SELECT * FROM r_iv",
    "daily_stock_by_year": 'SELECT *, CAST(year("Date") AS INTEGER) AS "Year" FROM r_daily',
    "stock_snapshot": _SNAPSHOT,
    "stock_snapshot_advanced": _SNAPSHOT,
    "running_stock_since": f'SELECT * FROM r_run WHERE "Date" > {AS_OF}',
    "opening_stock_since": "SELECT * FROM r_open",
    "job_counts": f"""
SELECT 'movements_rows' AS Name, COUNT(*) AS Value FROM stock_movements
UNION ALL SELECT 'null_movements', COUNT(*) - (SELECT COUNT(*) FROM m_clean) FROM stock_movements
UNION ALL SELECT 'sales_rows', COUNT(*) FROM sales
UNION ALL SELECT 'null_sales', COUNT(*) - (SELECT COUNT(*) FROM s_clean) FROM sales
UNION ALL SELECT 'unmatched_sales', COUNT(*) FROM s_period s WHERE NOT EXISTS (SELECT 1 FROM p_clean p WHERE p.ProductId = s.ProductId)
UNION ALL SELECT 'unmatched_movements', COUNT(*) FROM m_period m WHERE NOT EXISTS (SELECT 1 FROM p_clean p WHERE p.ProductId = m.ProductId)
UNION ALL SELECT 'movement_quantity', CAST(SUM(Quantity) AS BIGINT) FROM r_mov WHERE "Date" <= {END}
UNION ALL SELECT 'cube_quantity', CAST(SUM(Quantity) AS BIGINT) FROM f_net WHERE "Date" <= {END}
""",
    "nonpositive_intervals": "SELECT * FROM r_iv_all WHERE Stock <= 0",
    "interval_stock_family": "SELECT * FROM f_iv",
    "net_movements_family": "SELECT * FROM f_net",
    "pruned_stock_family": f"""
SELECT Family, StoreId, "Date", Stock,
       CASE WHEN n_rows = 1 AND Stock = 0 AND "Date" = {START} THEN 'lone_zero_opening' ELSE 'all_negative' END AS Reason
FROM f_flags WHERE (n_rows = 1 AND Stock = 0 AND "Date" = {START}) OR n_non_negative = 0""",
    "nonpositive_intervals_family": "SELECT * FROM f_iv_all WHERE Stock <= 0",
    "daily_stock": "SELECT * FROM r_daily",
    "daily_stock_family": "SELECT * FROM f_daily",
    "revenue_by_family": 'SELECT "Year", Family, CAST(Revenue AS DOUBLE) AS Revenue FROM rev_family',
    "revenue_by_store": 'SELECT "Year", StoreId, CAST(Revenue AS DOUBLE) AS Revenue FROM rev_store',
    "cost_by_family": 'SELECT "Year", Family, CAST(Cost AS DOUBLE) AS Cost FROM cost_family',
    "cost_by_store": 'SELECT "Year", StoreId, CAST(Cost AS DOUBLE) AS Cost FROM cost_store',
    "family_benefits": _profit("Family", "family"),
    "store_benefits": _profit("StoreId", "store"),
    "units_by_family": "SELECT * FROM units_family",
    "units_by_store": "SELECT * FROM units_store",
    "stock_days_family": "SELECT * FROM sd_family",
    "stock_days_store": "SELECT * FROM sd_store",
    "days_in_year": """
SELECT DISTINCT "Year",
       CAST(CASE WHEN ("Year" % 4 = 0 AND "Year" % 100 <> 0) OR "Year" % 400 = 0 THEN 366 ELSE 365 END AS INTEGER)
         AS DaysInTheYear
FROM sd_family""",
    "avg_stock_family": "SELECT * FROM avg_family",
    "avg_stock_store": "SELECT * FROM avg_store",
    "family_rotation": _turnover("Family", "family"),
    "store_rotation": _turnover("StoreId", "store"),
    "kpi_summary": """
SELECT CASE WHEN GROUPING(StoreId) = 1 THEN 'Family' ELSE 'StoreId' END AS Grain, "Year", StoreId, Family,
       CAST(SUM(Revenue) AS DOUBLE) AS Revenue, CAST(SUM(Cost) AS DOUBLE) AS Cost,
       CAST(SUM(UnitsSold) AS BIGINT) AS UnitsSold, CAST(SUM(StockDays) AS BIGINT) AS SumStock,
       CAST(SUM(SalesRows) AS BIGINT) AS SalesRows, CAST(SUM(CostRows) AS BIGINT) AS CostRows,
       CAST(SUM(StockRows) AS BIGINT) AS StockRows
FROM kpi_facts GROUP BY GROUPING SETS (("Year", StoreId), ("Year", Family))""",
    "shape_movements": 'SELECT COUNT(*) AS "Rows", CAST(4 AS INTEGER) AS "Columns" FROM stock_movements',
    "shape_sales": 'SELECT COUNT(*) AS "Rows", CAST(4 AS INTEGER) AS "Columns" FROM sales',
    "shape_products": 'SELECT COUNT(*) AS "Rows", CAST(5 AS INTEGER) AS "Columns" FROM products',
    "profile_sales": _profile("sales", ["StoreId", "ProductId", "Quantity"]),
    "profile_products": _profile(
        "products", ["ProductRootCode", "ProductId", "SupplierPrice", "RetailPrice"], ["Family"]
    ),
    "profile_movements": _profile("stock_movements", ["StoreId", "ProductId", "Quantity"]),
    "date_range_movements": 'SELECT MIN("Date") AS MinDate, MAX("Date") AS MaxDate FROM stock_movements',
    "date_range_sales": 'SELECT MIN("Date") AS MinDate, MAX("Date") AS MaxDate FROM sales',
    "reconcile_quantity": """
SELECT er AS EnrichedRoot, nr AS NetRoot, ef AS EnrichedFamily, nf AS NetFamily,
       (er = nr AND nr = ef AND ef = nf) AS Balanced
FROM (SELECT (SELECT CAST(COALESCE(SUM(Quantity), 0) AS BIGINT) FROM r_mov) AS er,
             (SELECT CAST(COALESCE(SUM(Quantity), 0) AS BIGINT) FROM r_net) AS nr,
             (SELECT CAST(COALESCE(SUM(Quantity), 0) AS BIGINT) FROM f_mov) AS ef,
             (SELECT CAST(COALESCE(SUM(Quantity), 0) AS BIGINT) FROM f_net) AS nf) t""",
    "reconcile_days": """
SELECT d AS IntervalDays, n AS DailyRows, d = n AS Balanced
FROM (SELECT (SELECT CAST(COALESCE(SUM(EndDate - StartDate + 1), 0) AS BIGINT) FROM r_iv) AS d,
             (SELECT COUNT(*) FROM r_daily) AS n) t""",
    "compare_grains": """
SELECT r AS RootStock, f AS FamilyStock, r <> f AS Differ
FROM (SELECT (SELECT CAST(COALESCE(SUM(Stock), 0) AS BIGINT) FROM r_daily) AS r,
             (SELECT CAST(COALESCE(SUM(Stock), 0) AS BIGINT) FROM f_daily) AS f) t""",
}


_BODIES["daily_stock_job"] = _BODIES["daily_stock"]  # the published plans, same results
_BODIES["interval_stock_written"] = _BODIES["interval_stock"]
for _name in ("store_benefits", "family_benefits", "store_rotation", "family_rotation"):
    _BODIES[f"{_name}_job"] = _BODIES[_name]
_BODIES["duplicate_products"] = 'SELECT ProductId, COUNT(*) AS "Rows" FROM products GROUP BY ProductId HAVING COUNT(*) > 1'
for _name in ("interval_stock", "daily_stock", "kpi_summary"):
    _BODIES[f"{_name}_incremental"] = _BODIES[_name]
_BODIES["kpi_summary_job"] = _BODIES["kpi_summary"]  # same result, computed by the job's plan


def oracle_queries() -> dict[str, str]:
    out = {}
    for name, body in _BODIES.items():
        prelude = PRELUDE.rstrip() + ("," + _KPI_FACTS if name.startswith("kpi_summary") else "\n")
        out[name] = prelude + body.strip() + "\n"
    return out
