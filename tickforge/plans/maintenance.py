"""Table maintenance jobs: keyed dedup of a stored table (W1/W2 + S14)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .. import schemas
from ..operators.commits import finish
from ..operators.quality import dedup_by_key, duplicate_groups
from ..operators.tables import DATE, SEQUENCE, read_table, replace_table
from .ingest import partitions_of, table_schema


def dedup_table(spark: SparkSession, path: str, keys: list[str],
                order_by: list[str] | None = None,
                partition_by: list[str] | None = None,
                schema: StructType | None = None) -> None:
    """Rewrite the Parquet table at ``path`` keeping the first row per key.

    "First" is the order of arrival (``ingest_seq``) where the table has it,
    unless ``order_by`` says otherwise.  The table is replaced in one commit.
    """
    finish(spark, path)
    stored = read_table(spark, path, schema)
    if order_by is None and SEQUENCE in stored.columns:
        order_by = [SEQUENCE]
    replace_table(dedup_by_key(stored, keys, order_by), path, partition_by)


def _funding_schema(spark: SparkSession, path: str, ntz: bool) -> tuple[StructType, list[str] | None]:
    """The stored schema of the funding feed, by the columns that its folder has."""
    names = read_table(spark, path).columns
    dated = DATE in names
    return table_schema("funding_rates", ntz, dated=dated, numbered=SEQUENCE in names), (
        partitions_of("funding_rates") if dated else None)


def dedup_funding_table(spark: SparkSession, path: str,
                        order_by: list[str] | None = None, ntz: bool = True) -> None:
    """`dedup_table` on the funding feed's (timestamp, currency) key."""
    finish(spark, path)
    schema, partitions = _funding_schema(spark, path, ntz)
    dedup_table(spark, path, schemas.FUNDING_DEDUP_KEY, order_by, partitions, schema)


def funding_duplicates(spark: SparkSession, path: str, ntz: bool = True) -> DataFrame:
    """(timestamp, currency, dups) of the stored funding feed, dups > 1."""
    return duplicate_groups(read_table(spark, path, _funding_schema(spark, path, ntz)[0]), schemas.FUNDING_DEDUP_KEY)
