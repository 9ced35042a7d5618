"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "clicklake", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; sizes are left to the deployment."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine: executors elsewhere could not read it.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="clicklake-"))
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/clicklake/{label}-{uuid.uuid4().hex}"
