"""Table-level operations: append (S8), insert-if-absent (S9), resume
points (S10), ingest slice (S11) and replace (S14)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from ..functions.time import as_text, plus, ts_literal
from ..session import ensure_utc
from .commits import current_folder, finish, replace
from .quality import dedup_by_key

# Fixed value: history start used when a table holds nothing yet.
DEFAULT_START = datetime(2022, 10, 1, 0, 0, 0)
# Derived partition column of the tick tables.
DATE = "trade_date"
TICK_PARTITIONS = ["currency", DATE]


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a table; every other failure is an error."""
    return current_folder(spark, path) is not None


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The stored table, empty if it was never written.

    The schema is given, not inferred (without one the table must exist).  A
    folder that exists but cannot be read stops the job: taking it for empty
    would store its rows again.  While a replacement is being tidied up, or
    was cut off by a crash, the committed files are read (`commits`).
    """
    ensure_utc(spark)
    folder = current_folder(spark, path)
    if folder is None:
        if schema is None:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(folder)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast to the table schema, by name, in table order."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def append(df: DataFrame, path: str, schema: StructType | None = None,
           partition_by: list[str] | None = None, ts: str = "timestamp") -> None:
    """Append rows (no key check).

    ``partition_by`` may name ``trade_date``, the day of ``ts``.  Whether a
    failed append leaves rows behind depends on the output committer.
    """
    out = conform(df, schema) if schema is not None else df
    finish(df.sparkSession, path)
    if partition_by:
        if DATE in partition_by and DATE not in out.columns:
            out = out.withColumn(DATE, F.to_date(F.col(ts)))
        out.write.mode("append").partitionBy(*partition_by).parquet(path)
    else:
        out.write.mode("append").parquet(path)


def assert_keys_not_null(df: DataFrame, keys: list[str]) -> DataFrame:
    """Fail the job on a NULL key, like a primary-key constraint."""
    any_null = None
    for k in keys:
        c = F.col(k).isNull()
        any_null = c if any_null is None else (any_null | c)
    check = F.when(any_null, F.raise_error(F.lit("NULL value in key column(s) " + ",".join(keys))))
    # A filter (not a dropped column, which Catalyst would prune unevaluated).
    return df.where(F.coalesce(check.cast("boolean"), F.lit(True)))


def rows_to_insert(existing: DataFrame, batch: DataFrame, keys: list[str],
                   order_by: list[str] | None = None,
                   assume_unique: bool = False) -> DataFrame:
    """Rows of ``batch`` whose key is not stored yet; first row per key wins.

    The batch is first reduced to one row per key (an aggregation, so a
    hot key is combined map-side), then anti-joined with the stored keys.
    ``assume_unique`` skips the reduction for batches whose keys are unique
    by construction (e.g. the output of a ``groupBy`` on those keys).
    """
    batch = assert_keys_not_null(batch, keys)
    first = batch if assume_unique else dedup_by_key(batch, keys, order_by)
    return first.join(existing.select(*keys), keys, "left_anti").select(*batch.columns)


def insert_if_absent(existing: DataFrame, batch: DataFrame, keys: list[str],
                     order_by: list[str] | None = None) -> DataFrame:
    """The table after ``INSERT OR IGNORE`` (existing rows win)."""
    new = rows_to_insert(existing, batch, keys, order_by)
    return existing.unionByName(new.select(*existing.columns))


def within_range(stored: DataFrame, batch: DataFrame, ts: str) -> DataFrame:
    """The stored rows that a row of ``batch`` could equal in the time ``ts``.

    The batch's first and last time (one row is collected) become literals
    that reach the scan: row groups, and the days of a table partitioned by
    them, outside of the batch's range are not read.
    """
    dtype = stored.schema[ts].dataType
    low, high = batch.agg(as_text(F.min(ts)), as_text(F.max(ts))).first()
    if low is None:
        return stored.where(F.lit(False))
    own = stored.where(F.col(ts).between(ts_literal(low, dtype), ts_literal(high, dtype)))
    if DATE in stored.columns:
        own = own.where(F.col(DATE).between(F.lit(low[:10]).cast("date"), F.lit(high[:10]).cast("date")))
    return own


def write_if_absent(spark: SparkSession, batch: DataFrame, path: str, keys: list[str],
                    schema: StructType, order_by: list[str] | None = None,
                    partition_by: list[str] | None = None,
                    assume_unique: bool = False, within: str | None = None) -> int:
    """Append the absent rows of ``batch`` to the Parquet table at ``path``.

    ``within`` names a time column that belongs to the key, or that a row
    keeps when it comes again: only the stored rows in the batch's range of
    it are looked through, not the whole store.  The rows to insert are
    checkpointed (reliable, in ``spark.checkpoint.dir``) before the append,
    because the plan reads the table it writes to.  Single writer per table.
    Returns the number of rows appended.
    """
    dated = bool(partition_by) and DATE in partition_by and DATE not in schema.names
    stored = read_table(spark, path, StructType([*schema.fields, StructField(DATE, DateType())]) if dated else schema)
    batch = conform(batch, schema)
    if within is not None:
        stored = within_range(stored, batch, within)
    new = rows_to_insert(stored, batch, keys, order_by, assume_unique).checkpoint(eager=True)
    n = new.count()
    if n or not table_exists(spark, path):
        append(new, path, schema, partition_by)
    return n


def resume_points(trades: DataFrame, currencies: list[str] | None = None,
                  default_start: datetime = DEFAULT_START, by: str | None = "currency",
                  ts: str = "timestamp") -> DataFrame:
    """Per currency ``max(ts) + 1 ms``, else the configured start (UTC).

    ``by=None`` gives one global row (the spot table has no currency).
    ``currencies`` lists the currencies expected even when they have no
    rows yet (they get ``default_start``).
    """
    start = ts_literal(default_start, trades.schema[ts].dataType)
    if by is None:
        return trades.agg(F.coalesce(plus(F.max(ts), "1 MILLISECOND"), start).alias("resume_ts"))
    seen = trades.groupBy(by).agg(plus(F.max(ts), "1 MILLISECOND").alias("_next"))
    if currencies:
        spark = trades.sparkSession
        wanted = spark.createDataFrame([(c,) for c in currencies], [by])
        seen = wanted.join(seen, by, "full_outer")
    return seen.select(by, F.coalesce(F.col("_next"), start).alias("resume_ts"))


MAX_BOUNDS = 10_000    # values of ``by`` that become a literal predicate


def bounds_predicate(bounds: DataFrame, by: str, bound: str, ts: str, dtype,
                     new: Column | None = None, dates: bool = False) -> Column | None:
    """``ts >= bound`` of the row's own ``by`` value, as literals.

    ``bounds`` has one row per value (checked: ``MAX_BOUNDS``).  Values
    without a bound are kept where ``new`` holds (everywhere when None).
    ``dates`` adds the day, which prunes a table partitioned by it.  None
    when there are no bounds.
    """
    rows = bounds.where(F.col(bound).isNotNull()).select(by, as_text(F.col(bound)).alias("b")).limit(MAX_BOUNDS + 1).collect()
    if len(rows) > MAX_BOUNDS:
        raise ValueError(f"more than {MAX_BOUNDS} values of {by}: not a currency-like column")
    if not rows:
        return None
    unknown = F.col(by).isNull() | ~F.col(by).isin(*[r[by] for r in rows if r[by] is not None])
    pred = unknown if new is None else unknown & new
    for r in rows:
        one = F.col(by).eqNullSafe(F.lit(r[by])) & (F.col(ts) >= ts_literal(r["b"], dtype))
        if dates:
            one = one & (F.col(DATE) >= F.lit(r["b"][:10]).cast("date"))
        pred = pred | one
    return pred


def ingest_slice(landed: DataFrame, resume: DataFrame, end=None, by: str | None = "currency",
                 ts: str = "timestamp", default_start=None) -> DataFrame:
    """The landed rows still to ingest: ``resume <= ts <= end``.

    ``resume`` is the output of `resume_points`: one row per currency (or
    one global row when ``by`` is None).  It is collected - its size is the
    number of currencies - and turned into a literal predicate, which the
    Parquet scan can push down and a date/currency-partitioned table can
    prune on.  A currency with no resume row has nothing stored yet: its
    rows are kept from ``default_start`` on (all of them when None), as the
    reference starts a new currency from its configured start.  ``end`` is
    the inclusive upper bound (the reference stops at last midnight UTC).
    Times without a zone are UTC, whatever the driver's own zone.
    """
    dtype = landed.schema[ts].dataType
    new = None if default_start is None else F.col(ts) >= ts_literal(default_start, dtype)
    if by is None:
        rows = resume.select(as_text(F.col("resume_ts")).alias("b")).limit(1).collect()
        pred = F.col(ts) >= ts_literal(rows[0]["b"], dtype) if rows else F.lit(True)
    else:
        pred = bounds_predicate(resume, by, "resume_ts", ts, dtype, new)
        if pred is None:
            pred = F.lit(True) if new is None else new
    if end is not None:
        pred = pred & (F.col(ts) <= ts_literal(end, dtype))
    return landed.where(pred)


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """``CREATE OR REPLACE TABLE t AS <query over t>``.

    One commit (`commits.replace`): a crash at any step leaves the old or the
    new table.  ``df`` may read the table, by `read_table`, so an open commit
    of an earlier run has to be finished before ``df`` is made.
    """
    replace(df, path, partition_by)


# -- order of arrival

SEQUENCE = "ingest_seq"


def number_rows(rows: DataFrame, start: int, order_by: list[Column], name: str = SEQUENCE) -> DataFrame:
    """``rows`` numbered without gaps from ``start + 1`` in the given order.

    The rows are sorted by ranges and checkpointed with their place in their
    partition; a partition's first number follows from the counts of those
    before it (one row a partition), so no task sees all rows.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place, part = F.col("_place"), F.shiftright("_place", 33)
    rows = (rows.repartitionByRange(n, *order_by).sortWithinPartitions(*order_by)
            .withColumn("_place", F.monotonically_increasing_id()).checkpoint(eager=True))
    starts = []
    for r in sorted(rows.groupBy(part.alias("_part")).count().collect()):
        starts.append((r[0], start))
        start += r[1]
    firsts = rows.sparkSession.createDataFrame(starts, "_part long, _first long")
    number = F.col("_first") + place.bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return (rows.withColumn("_part", part.cast("long")).join(F.broadcast(firsts), "_part")
            .withColumn(name, number).drop("_part", "_first", "_place"))


def last_number(stored: DataFrame, name: str = SEQUENCE) -> int:
    """The greatest number given to a stored row so far, 0 without any."""
    return stored.agg(F.max(name)).first()[0] or 0


# -- the newest stored tick


def newest_path(path: str) -> str:
    """The table beside ``path`` that holds each currency's newest time."""
    return f"{path.rstrip('/')}.newest"


def newest_ticks(spark: SparkSession, path: str, dtype, by: str = "currency") -> DataFrame | None:
    """``by`` and newest, one row per currency; None where nothing is noted yet."""
    if not table_exists(spark, newest_path(path)):
        return None
    return read_table(spark, newest_path(path), StructType([StructField(by, StringType()), StructField("newest", dtype)]))


def note_newest(stored: DataFrame, added: DataFrame, path: str, by: str = "currency", ts: str = "timestamp") -> None:
    """Note the newest time per currency after ``added`` was appended to the table ``stored`` at ``path``.

    The whole table is read only when nothing is noted yet.  The note is
    replaced in one commit after the append: a crash between the two leaves it
    older than the ticks, so that minutes are closed by the next append, and
    never one too early.  Whoever appends by other means than the ingests
    calls this too.
    """
    spark = stored.sparkSession
    finish(spark, newest_path(path))
    known = newest_ticks(spark, path, stored.schema[ts].dataType, by)
    rows = stored if known is None else added
    now = rows.where(F.col(by).isNotNull()).groupBy(by).agg(F.max(ts).alias("newest"))
    if known is not None:
        now = known.unionByName(now).groupBy(by).agg(F.max("newest").alias("newest"))
    replace_table(now.coalesce(1), newest_path(path))
