"""Session helpers: a local session for tests/bench and the shared checkpoint folder.

On a cluster the caller owns the session; nothing here overrides settings that are
already present, and the checkpoint folder is always read from the session's
``spark.checkpoint.dir`` first.
"""

from __future__ import annotations

import posixpath
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings we want for every run of the library. They are applied only where the
# session has no value of its own, so a cluster configuration always wins.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "tabprism", event_log_dir: str | None = None) -> SparkSession:
    """A local[N] session for tests and the bench (UI off, loopback only)."""
    parts = shuffle_partitions or (8 if cpus == "*" else max(2, int(cpus)))
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.driver.bindAddress", "127.0.0.1")
         .config("spark.driver.host", "127.0.0.1")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.shuffle.partitions", str(parts)))
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if event_log_dir:
        b = (b.config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", event_log_dir))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    Order: ``spark.checkpoint.dir`` from the session, then the SparkContext's
    checkpoint directory. Only a local session (tests) without either gets a scratch
    folder; on a cluster that is an error, as executors would not share it.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    existing = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not (current or existing) and not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not current:
        current = existing or tempfile.mkdtemp(prefix="tabprism-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", current)
        except Exception:  # core conf may be read-only in this session; the context dir suffices
            pass
    if not existing:
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder (not yet made) in the shared checkpoint folder."""
    return posixpath.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
