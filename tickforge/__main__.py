"""``python -m tickforge setup|update`` (or spark-submit with this module).

setup   writes the ten tables, empty, with their typed schemas
update  ingests landed page folders, then runs the aggregation phase

Landed layout: ``<landed>/<feed>/`` with one JSON document per line:
``{"currency": ..., "page": ...}`` for the trade feeds (future,
future_combo, option, spot), ``{"instrument_name": ..., "page": ...}`` for
funding and ``{"source_rank": 0|1, "page": ...}`` for instruments.  Tables
live in ``<tables>/<table_name>``.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql.types import TimestampNTZType, TimestampType

from . import schemas
from .operators.tables import append, table_exists
from .plans.ingest import partitions_of
from .session import build_session

FEEDS = {"future": "currency string, page string", "future_combo": "currency string, page string",
         "option": "currency string, page string", "spot": "currency string, page string",
         "funding": "instrument_name string, page string",
         "instruments": "source_rank int, page string"}


def _paths(tables: str) -> dict[str, str]:
    return {t: f"{tables.rstrip('/')}/{t}" for t in schemas.TABLES}


def _ntz(schema):
    from pyspark.sql.types import StructField, StructType
    return StructType([StructField(f.name, TimestampNTZType() if isinstance(f.dataType, TimestampType)
                                   else f.dataType, True) for f in schema.fields])


def setup(spark, tables: str) -> None:
    for name, path in _paths(tables).items():
        empty = spark.createDataFrame([], _ntz(schemas.TABLES[name]))
        if name.endswith("_trades") or name == "funding_rates":     # the folder; partitions come with the rows
            if not table_exists(spark, path):
                append(empty, path, partition_by=partitions_of(name))
        else:
            empty.write.mode("ignore").parquet(path)


def update(spark, landed: str, tables: str, mode: str, exact: bool = False) -> None:
    from .plans.ingest import update as run
    feeds = {}
    for feed, ddl in FEEDS.items():
        folder = f"{landed.rstrip('/')}/{feed}"
        if "://" in folder or os.path.isdir(folder):
            feeds[feed] = spark.read.schema(ddl).json(folder)
    run(spark, feeds, _paths(tables), mode=mode, exact=exact)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tickforge")
    sub = ap.add_subparsers(dest="command", required=True)
    s = sub.add_parser("setup", help="create the tables (empty, typed)")
    s.add_argument("--tables", required=True)
    u = sub.add_parser("update", help="ingest landed pages, then update the aggregates")
    u.add_argument("--landed", required=True)
    u.add_argument("--tables", required=True)
    u.add_argument("--mode", choices=["resume", "by_trade_id"], default="resume")
    u.add_argument("--exact", action="store_true", help="recompute all hours of the term structures")
    args = ap.parse_args(argv)
    spark = build_session()
    if args.command == "setup":
        setup(spark, args.tables)
    else:
        update(spark, args.landed, args.tables, args.mode, args.exact)


if __name__ == "__main__":
    main()
