"""Sources and sinks: Parquet tables and the test-data fixture derivation."""

from stockroom.sources.fixtures import derive_inputs, write_inputs
from stockroom.sources.parquet import Inputs, dates_to_timestamps, read_inputs, read_table, write_table

__all__ = [
    "Inputs",
    "dates_to_timestamps",
    "derive_inputs",
    "read_inputs",
    "read_table",
    "write_inputs",
    "write_table",
]
