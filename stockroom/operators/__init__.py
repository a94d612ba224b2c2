"""DataFrame -> DataFrame operators of the retail stock and sales engine."""

from stockroom.operators.enrich import enrich, enrich_filtered, enrich_marked, period_filter, product_dimension, sized_broadcast, unmatched
from stockroom.operators.keyfilter import filter_bits, may_contain
from stockroom.operators.kpi import (
    average_stock,
    benefits_from_summary,
    inbound_cost,
    interval_years,
    kpi_facts,
    kpi_summary,
    line_amount,
    profit,
    revenue,
    rotation_from_summary,
    stock_days,
    turnover,
    units_sold,
    with_price_units,
)
from stockroom.operators.ledger import (
    active_timeline,
    change_intervals,
    densify_by_year,
    densify_daily,
    ledger,
    ledger_in_order,
    net_movements,
    nonpositive_intervals,
    opening_stock,
    positive_intervals,
    prunable_keys,
    running_stock,
    stock_timeline,
)
from stockroom.operators.quality import (
    clean,
    compare_grains,
    date_range,
    duplicate_products,
    null_rejects,
    profile,
    reconcile_days,
    reconcile_quantity,
    table_shape,
)
from stockroom.operators.snapshot import absorb, advance, late_movements, opening_since, running_since, since, stock_snapshot

__all__ = [
    "absorb",
    "active_timeline",
    "advance",
    "average_stock",
    "benefits_from_summary",
    "change_intervals",
    "clean",
    "compare_grains",
    "date_range",
    "densify_by_year",
    "densify_daily",
    "duplicate_products",
    "enrich",
    "enrich_filtered",
    "enrich_marked",
    "filter_bits",
    "inbound_cost",
    "interval_years",
    "kpi_facts",
    "kpi_summary",
    "late_movements",
    "ledger",
    "ledger_in_order",
    "line_amount",
    "may_contain",
    "net_movements",
    "nonpositive_intervals",
    "null_rejects",
    "opening_since",
    "opening_stock",
    "period_filter",
    "positive_intervals",
    "product_dimension",
    "profile",
    "profit",
    "prunable_keys",
    "reconcile_days",
    "reconcile_quantity",
    "revenue",
    "rotation_from_summary",
    "running_since",
    "running_stock",
    "since",
    "sized_broadcast",
    "stock_days",
    "stock_snapshot",
    "stock_timeline",
    "table_shape",
    "turnover",
    "units_sold",
    "unmatched",
    "with_price_units",
]
