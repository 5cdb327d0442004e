"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math
import os

import duckdb

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations"]


def duckdb_with_views(sf_dir: str):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _isnull(x) -> bool:
    if x is None:
        return True
    if isinstance(x, float):
        return False
    try:
        import pandas as pd
        return bool(pd.isna(x))
    except (TypeError, ValueError):
        return False


def _norm(v, digits: int):
    if _isnull(v):
        return None
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            v = v.item()
        except (AttributeError, ValueError):
            pass
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        return float(f"{v:.{digits}g}")
    if hasattr(v, "isoformat"):
        return str(v).replace("T", " ")
    return v


def _canon(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(x, 17) for x in rec) for rec in pdf[cols].itertuples(index=False)]
    return cols, rows


def _sort_key(row):
    exact = tuple("" if v is None else str(v) for v in row if not isinstance(v, float))
    approx = tuple(f"{v:.6g}" for v in row if isinstance(v, float))
    return exact + approx


def _close(a, b, rel: float) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=rel, abs_tol=1e-12)
    if isinstance(a, float) and isinstance(b, int) or isinstance(b, float) and isinstance(a, int):
        return math.isclose(float(a), float(b), rel_tol=rel, abs_tol=1e-12)
    return a == b


def compare(spark_pdf, oracle_pdf, rel: float = 1e-9) -> str | None:
    """None when equal (floats within ``rel``), else a short description.

    Rows are matched after sorting by their exact (non-float) values, so
    the comparison is order-insensitive.
    """
    sc, srows = _canon(spark_pdf)
    oc, orows = _canon(oracle_pdf)
    if sc != oc:
        return f"columns differ: spark={sc} oracle={oc}"
    if len(srows) != len(orows):
        return f"row count spark={len(srows)} oracle={len(orows)}"
    srows.sort(key=_sort_key)
    orows.sort(key=_sort_key)
    bad = [(a, b) for a, b in zip(srows, orows)
           if len(a) != len(b) or not all(_close(x, y, rel) for x, y in zip(a, b))]
    if bad:
        return f"{len(bad)} rows differ, e.g. spark={bad[0][0]} oracle={bad[0][1]} (cols {sc})"
    return None
