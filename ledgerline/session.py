"""Session helpers for tests, the bench and local runs.

On a cluster the session comes from ``spark-submit``; nothing here overrides
settings that are already present.  ``checkpoint_dir`` reads the shared
folder the cluster names in ``spark.checkpoint.dir``; where none is set it
makes a local one for a ``local`` master (tests) and fails on a cluster.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.shuffle.partitions": "8",
}


def local_session(master: str | None = None, app_name: str = "ledgerline", conf=None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app_name)
    settings = dict(LOCAL_CONF)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder; set from ``spark.checkpoint.dir`` if needed.

    A machine-local folder is used for a ``local`` master only: executors on
    other machines could not read it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder, for written round trips."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/ledgerline-scratch/{uuid.uuid4().hex}/{name}"
