"""Session helpers: a local session for tests/bench and a shared scratch folder.

On a cluster the scratch folder is whatever ``spark.checkpoint.dir`` names (a
shared file system path).  Only when that setting is absent -- local tests --
do we point it at a fresh temporary folder.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Text features are CPU-heavy per byte: do not merge post-shuffle
    # partitions below 128 KB into one task (the 1 MB default serialises
    # small-but-expensive stages on one core).
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "16g", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a local session configured like the tests expect."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName("relevo")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", driver_memory))
    for k, v in {**_DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = path.get() if path.isDefined() else None
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all "
                               "executors share; a machine-local one would lose staged tables")
        path = tempfile.mkdtemp(prefix="relevo-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for a written stage."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
