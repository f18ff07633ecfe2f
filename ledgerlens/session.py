"""Session helpers.

On a cluster the session is created by the platform; ``configure`` only fills in
settings that are unset, so cluster-provided values (shuffle partitions,
checkpoint dir, AQE knobs) always win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. Applied only where the session leaves them unset.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ledgerlens", event_log_dir: str | None = None) -> SparkSession:
    """Local session for tests and the bench (UI off, no extra ports)."""
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("LEDGERLENS_DRIVER_MEMORY", "16g"))
         .config("spark.sql.session.timeZone", "UTC"))
    if event_log_dir:
        b = (b.config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", event_log_dir))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    for k, v in _DEFAULTS.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when the session leaves it unset (tests, local runs) a private scratch
    folder is created and registered. Jobs cut long lineages with
    ``DataFrame.checkpoint()`` (reliable, survives executor loss), never with
    ``localCheckpoint``.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster's "
                               "distributed file system); a machine-local folder would not survive "
                               "executor loss")
        d = tempfile.mkdtemp(prefix="ledgerlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(d)
    return d


def cut(df):
    """Materialise a stage and cut its lineage (reliable checkpoint in the
    shared ``spark.checkpoint.dir``): later stages re-read it instead of
    re-parsing sources, and a lost executor does not replay the whole plan."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
