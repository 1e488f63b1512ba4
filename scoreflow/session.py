"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_scratch: tempfile.TemporaryDirectory | None = None


def build_session(app: str = "scoreflow", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs expect; `conf` entries win.

    `master` is left to spark-submit unless given.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path for intermediate tables and stream checkpoints.

    It lies in the shared folder named by `spark.checkpoint.dir`. Only a local
    master may run without that setting; it then gets a folder of its own that
    goes away with the process.
    """
    global _local_scratch
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        # Not local-cluster, whose executors are processes of their own.
        if master != "local" and not master.startswith("local["):
            raise ValueError(
                "set spark.checkpoint.dir to a folder that every executor can reach"
            )
        if _local_scratch is None:
            _local_scratch = tempfile.TemporaryDirectory(prefix="scoreflow-")
        base = _local_scratch.name
    return f"{base.rstrip('/')}/scoreflow/{label}-{uuid.uuid4().hex}"
