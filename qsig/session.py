"""Session helpers.

The library itself never creates a session: every operator takes and returns a
``DataFrame``.  These helpers exist for tests, the benchmark and the example
jobs.  On a cluster the session comes from ``spark-submit`` and its settings
(shuffle partitions, checkpoint directory, AQE) are the deployment's.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings a job relies on for correctness or for plan shape, applied to a
# session built here.  ANSI mode stays at Spark's default (on).
_BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # local data is small: without this AQE merges a few-MB shuffle into one
    # partition and a downstream explode then runs in a single task
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "qsig", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (never used on a cluster)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g"))
    for k, v in {**_BASE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint directory.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is (it is required there).  Only a local-mode session without one gets
    a scratch folder, as in tests.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder for staged tables")
    path = tempfile.mkdtemp(prefix="qsig-ckpt-", dir=os.environ.get("QSIG_SCRATCH", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()
