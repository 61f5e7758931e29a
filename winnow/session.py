"""Session helpers: building a session for tests/bench, locating the shared
checkpoint folder, and reading the shared input tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session settings for local runs.  On a cluster the operator code never
# touches global confs; it only reads them.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str = "local[8]", partitions: int = 8, app: str = "winnow",
                extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    for k, v in {**LOCAL_CONF, "spark.sql.shuffle.partitions": str(partitions), **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def is_local(master: str) -> bool:
    """Driver and tasks in one process, so a local folder is shared."""
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``.  Where it is
    unset, a local master gets a fresh scratch folder (tests); any other master
    raises, since a machine-local folder is not seen by other executors."""
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not is_local(sc.master):
            raise ValueError("spark.checkpoint.dir is not set: intermediate tables need a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="winnow-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory for written tables."""
    base = checkpoint_dir(spark)
    return f"{base.rstrip('/')}/winnow-{name}-{uuid.uuid4().hex[:12]}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
