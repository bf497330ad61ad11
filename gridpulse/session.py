"""Session settings for local runs; on a cluster the caller brings the session."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, app: str = "gridpulse", memory: str = "8g") -> SparkSession:
    """A local session in UTC with adaptive execution; used by tests and bench."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def local_scratch(master: str) -> str:
    """A folder for scratch tables of a one-process session, gone with the process."""
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="gridpulse-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return f"file://{path}"
