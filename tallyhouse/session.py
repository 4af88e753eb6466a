"""Session builder and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "tallyhouse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    Broadcasting is left to Spark: it compares the (estimated, then with AQE the
    measured) size of a side with ``autoBroadcastJoinThreshold`` and falls back to a
    shuffle join above it, so no join in this package carries a broadcast hint.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        # call sites for error messages cost several round trips per column expression
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="tallyhouse-", dir=os.environ.get("TMPDIR", "/tmp"))
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
