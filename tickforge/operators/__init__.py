"""Relational operators of the library (all DataFrame -> DataFrame)."""

from .bars import ohlc_volume_bars, volume_bars
from .funding import funding_volume_bars, realized_funding
from .ohlc import futures_ohlc_1min, index_ohlc_1min, spot_ohlc_1min
from .quality import dedup_by_key, duplicate_groups, duplicate_rows
from .tables import insert_if_absent, replace_table, resume_points, rows_to_insert
from .term_structure import futures_term_structure, options_term_structure

__all__ = [
    "dedup_by_key", "duplicate_groups", "duplicate_rows", "funding_volume_bars",
    "futures_ohlc_1min", "futures_term_structure", "index_ohlc_1min", "insert_if_absent",
    "ohlc_volume_bars", "options_term_structure", "realized_funding",
    "replace_table", "resume_points", "rows_to_insert", "spot_ohlc_1min",
    "volume_bars",
]
