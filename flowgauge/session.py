"""Session for local runs, and the shared scratch folder of any session."""

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", app: str = "flowgauge", memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine. On a cluster, bring your own."""
    shuffles = os.cpu_count() if cores == "*" else int(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffles))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names.

    Only where that setting is empty and all tasks run in this process, as in tests, a folder of
    this machine is used. Elsewhere each executor would write to its own disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="flowgauge-")
    return f"{base.rstrip('/')}/flowgauge/{name}-{uuid.uuid4().hex}"
