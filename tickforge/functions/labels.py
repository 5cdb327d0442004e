"""Bucketing rules for term structures, as native CASE chains.

Right-closed edges (``x <= edge``); anything that fails every test
(NULL, NaN, beyond the last edge) falls into the last label, exactly as
a SQL ``CASE ... ELSE``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Expiry buckets (year fraction upper edge, label) of the
# futures term structure.
FUTURES_EXPIRY_EDGES = [(0.0383, "2w"), (0.0833, "1m"), (0.2500, "3m"), (0.5000, "6m")]
FUTURES_EXPIRY_ELSE = "12m"

# Expiry buckets of the options term structure.
OPTIONS_EXPIRY_EDGES = [(0.0082, "3d"), (0.0192, "1w"), (0.0383, "2w"),
                        (0.0833, "1m"), (0.2500, "3m"), (0.5000, "6m")]
OPTIONS_EXPIRY_ELSE = "12m"

# Absolute-delta buckets of the options term structure.
DELTA_EDGES = [(0.2, "0-0.2"), (0.4, "0.2-0.4"), (0.6, "0.4-0.6"), (0.8, "0.6-0.8")]
DELTA_ELSE = "0.8-1"


def right_closed(x: Column, edges, otherwise: str) -> Column:
    out = None
    for edge, label in edges:
        cond = x <= F.lit(edge)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(otherwise)


def futures_expiry_bucket(t_years: Column) -> Column:
    return right_closed(t_years, FUTURES_EXPIRY_EDGES, FUTURES_EXPIRY_ELSE)


def options_expiry_bucket(t_years: Column) -> Column:
    return right_closed(t_years, OPTIONS_EXPIRY_EDGES, OPTIONS_EXPIRY_ELSE)


def delta_bucket(abs_delta: Column) -> Column:
    return right_closed(abs_delta, DELTA_EDGES, DELTA_ELSE)


def right_closed_sql(x: str, edges, otherwise: str) -> str:
    whens = " ".join(f"WHEN {x} <= {edge} THEN '{label}'" for edge, label in edges)
    return f"CASE {whens} ELSE '{otherwise}' END"
