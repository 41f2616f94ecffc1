"""Spark session helpers.

The library never creates a session on its own inside an operator; callers
pass one in.  ``get_spark`` exists for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE re-plans joins (broadcast vs sort-merge)
# from runtime sizes, coalesces small shuffle partitions and splits skewed
# ones; the broadcast threshold stays at Spark's 10 MB default so nothing
# whose size grows with the data is ever broadcast by accident.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "vireo", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app_name)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    # under spark-submit (it opens the gateway) master and memory are its own
    submitted = "PYSPARK_GATEWAY_PORT" in os.environ
    master = master or os.environ.get("VIREO_MASTER") or (None if submitted else "local[8]")
    if master:
        b = b.master(master)
    if not submitted:
        b = b.config("spark.driver.memory", os.environ.get("VIREO_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is always used as
    is.  Only when it is unset and the master is local (tests) a scratch folder
    is created; on a cluster a missing setting is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="vireo-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def cut_lineage(df):
    """Write the rows as Parquet below the shared checkpoint folder and read
    them again.

    Survives executor loss (unlike ``localCheckpoint``), and later readers
    take only the columns they need; used where a plan is reused by several
    actions or grows iteratively.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/vireo-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
