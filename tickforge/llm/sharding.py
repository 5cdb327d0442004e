"""Fixed virtual slots (operator 2).

Records are hashed into a fixed number of slots, thousands of times fewer
than records and hundreds of times more than shards.  The bytes of each slot
are summed, and a slot-to-shard map decides where a slot's records live.
The map is versioned: rebalancing reads the newest version and the slots'
bytes, moves as few slots as it needs to make the shards' bytes near equal,
and stores the result as the next version.  Only the map and the slots'
bytes (``N_SLOTS`` numbers) ever reach the driver.

A record is hashed by its id and its text's size and checksum, so a key that
many records share does not fill one slot.  Rows that repeat entirely are
one record in this sense and stay together.  A null id or text hashes as
such.  A place in a shard is the sum of the rows before its slot plus the
row's number within the slot; numbering is dealt by slot and salt, so not
even a slot of repeated rows has to fit into one task.  Ties in the
rebalancing go to the lower shard and slot number.  Extra columns are not
read unless asked for; an empty table gives an empty result and a map.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

N_SLOTS = 8192
SALTS = 16
TOLERANCE = 0.0005       # of a shard's fair share, between the largest and the smallest shard
ROW_BYTES = 16           # counted for every row besides its text

MAP_SCHEMA = "version int, slot int, shard int"


def initial_map(n_slots: int, n_shards: int) -> np.ndarray:
    return np.arange(n_slots) % n_shards


def rebalance(shard_of: np.ndarray, load: np.ndarray, n_shards: int, tolerance: float = TOLERANCE) -> np.ndarray:
    """A copy of the map with slots moved (or exchanged) from full to empty shards.

    Slots of shards that are no more (``n_shards`` or above) are dealt out first.

    Each step takes the fullest and the emptiest shard and makes the move or
    exchange that brings both closest to their mean.  A shard that no step
    helps (its smallest slot may be above the mean) is left as it is; it ends
    when the others are near equal.
    """
    shard_of, load = shard_of.copy(), load.astype(np.int64)
    gone = shard_of >= n_shards
    shard_of[gone] = np.flatnonzero(gone) % n_shards
    total = np.bincount(shard_of, load, n_shards).astype(np.int64)
    allowed = tolerance * load.sum() / n_shards
    open_ = np.ones(n_shards, bool)
    for _ in range(4 * len(load)):
        if not open_.any():
            break
        high, low = int(np.argmax(np.where(open_, total, -1))), int(np.argmin(total))
        gap = int(total[high] - total[low])
        if gap <= max(allowed, 1):
            break
        mine, theirs = np.flatnonzero(shard_of == high), np.flatnonzero(shard_of == low)
        # what moves away: a slot's bytes, or those above the slot that comes back for it
        back = np.concatenate([[0], load[theirs]])
        back_order = np.argsort(back, kind="stable")
        want = load[mine] - gap / 2
        near = np.searchsorted(back[back_order], want)
        best = None
        for shift in (-1, 0):
            k = np.clip(near + shift, 0, len(back) - 1)
            moved = load[mine] - back[back_order[k]]
            off = np.abs(moved - gap / 2)
            off[(moved <= 0) | (moved >= gap)] = np.inf
            i = int(np.argmin(off))
            if np.isfinite(off[i]) and (best is None or off[i] < best[0]):
                best = float(off[i]), int(mine[i]), int(back_order[k[i]]), int(moved[i])
        if best is None:
            open_[high] = False
            continue
        _, slot, other, moved = best
        shard_of[slot] = low
        if other:
            shard_of[theirs[other - 1]] = high
        total[high] -= moved
        total[low] += moved
    return shard_of


def store_map(spark: SparkSession, folder: str, version: int, shard_of: np.ndarray) -> None:
    """Append a version; a version once stored is not changed."""
    rows = [(version, int(s), int(k)) for s, k in enumerate(shard_of)]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.parquet(f"{folder}/map-{version:06d}")


def newest_version(spark: SparkSession, folder: str) -> int | None:
    """The number of the newest stored map; None if there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/map-*/_SUCCESS")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return max((int(f.getPath().getParent().getName().split("-")[1]) for f in found), default=None)


def map_array(spark: SparkSession, folder: str, version: int) -> np.ndarray:
    """The shard of each slot (as many numbers as there are slots)."""
    rows = load_map(spark, folder, version).collect()
    shard_of = np.full(len(rows), -1)
    for r in rows:
        shard_of[r.slot] = r.shard
    return shard_of


def load_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    """slot and shard of one version (as many rows as there are slots)."""
    return spark.read.schema(MAP_SCHEMA).parquet(f"{folder}/map-{version:06d}").select("slot", "shard")


def slots(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_slots: int = N_SLOTS) -> DataFrame:
    """id, size, text_crc32 and the virtual slot of each record."""
    text = F.coalesce(docs[text_col], F.lit(""))
    sized = docs.select(docs[id_col].alias("__id"),
                        (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"),
                        docs[text_col].isNull().alias("__null"))
    return sized.select("__id", "size", "text_crc32",
                        F.pmod(F.xxhash64("__id", "size", "text_crc32", "__null"), F.lit(n_slots)).cast("int").alias("__slot"),
                        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int").alias("__salt"))


def shard(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text",
          n_slots: int = N_SLOTS, folder: str | None = None) -> DataFrame:
    """id, size, text_crc32, virtual_slot, shard and place of every row.

    The newest map in ``folder`` is rebalanced by the slots' bytes and stored
    as the next version; without one, version 0 deals the slots in turn.  So
    a later call, for more records or another number of shards, moves as few
    slots as it needs to.  ``place`` counts a shard's rows from 0.
    """
    spark = docs.sparkSession
    folder = folder or C.scratch_folder(spark, "slot-map")
    rows = C.written(slots(docs, id_col, text_col, n_slots), "slotted")
    load = np.zeros(n_slots, np.int64)
    for r in rows.groupBy("__slot").agg(F.sum("size").alias("b")).collect():   # at most n_slots rows
        load[r["__slot"]] = r["b"]
    version = newest_version(spark, folder)
    if version is None:
        version = 0
        store_map(spark, folder, version, initial_map(n_slots, n_shards))
    start = map_array(spark, folder, version)
    if len(start) != n_slots:
        raise ValueError(f"the map in {folder} has {len(start)} slots, not {n_slots}: slots are fixed")
    version += 1
    store_map(spark, folder, version, rebalance(start, load, n_shards))
    # n_slots rows of two numbers: small enough to broadcast whatever the data
    newest = F.broadcast(load_map(spark, folder, version))
    here = Window.partitionBy("__slot", "__salt")
    numbered = rows.withColumns({"__n": F.row_number().over(here.orderBy("__id", "text_crc32", "size")) - 1})
    counts = rows.groupBy("__slot", "__salt").agg(F.count("*").alias("__rows")).join(newest, F.col("__slot") == F.col("slot"))
    before = Window.partitionBy("shard").orderBy("__slot", "__salt").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("__slot", "__salt", "shard", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__first"))
    return numbered.join(first, ["__slot", "__salt"]).select(
        F.col("__id").alias(id_col), "size", "text_crc32", F.col("__slot").alias("virtual_slot"), "shard",
        (F.col("__first") + F.col("__n")).alias("place"))
