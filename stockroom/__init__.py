"""stockroom: retail stock ledger and sales KPIs as Spark DataFrame plans.

Inputs: ``products``, ``sales`` and ``stock_movements`` (Parquet). Outputs: ``interval_stock``,
``daily_stock``, ``store_benefits``, ``family_benefits``, ``store_rotation`` and
``family_rotation``. Every step is a DataFrame -> DataFrame operator in
:mod:`stockroom.operators`; :func:`stockroom.plans.run_pipeline` composes them.
"""

from stockroom.config import BUSINESS_PERIOD, FAMILY_GRAIN, FIXTURE_PERIOD, ROOT_GRAIN, Period

__all__ = ["BUSINESS_PERIOD", "FAMILY_GRAIN", "FIXTURE_PERIOD", "ROOT_GRAIN", "Period"]
