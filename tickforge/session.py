"""Session settings the library relies on.

All time arithmetic is defined in UTC (bars, hour buckets, second
differences).  `ensure_utc` pins the session zone; it is called by every
public entry point that turns timestamps into numbers.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins and coalesces small
# shuffle partitions at runtime, and splits skewed join partitions (a hot
# instrument or a hot duplicate key can hold a third of all rows).
SCALE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    # Streaming state on disk, not on the executors' heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "tickforge",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    On a cluster pass ``master=None`` and let spark-submit decide; tests
    and the bench pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SCALE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """All bucket / second arithmetic is UTC, as in the reference."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be a shared file system path set by the
    deployment; it is only invented here (under the system temp folder)
    in local mode, and missing it on a cluster is an error.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="tickforge-ckpt-")
    sc.setCheckpointDir(configured)
    return sc._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint dir, left to its writer."""
    import uuid
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
