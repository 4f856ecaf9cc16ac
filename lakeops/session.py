"""Session settings and the folder for written intermediate tables."""

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession


def local_session(cores: str = "8", name: str = "lakeops") -> SparkSession:
    """A session on one machine, for tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors see, below the one the cluster names.

    Only a session on one machine may fall back to a temporary folder of that machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors see")
        shared = tempfile.mkdtemp(prefix="run-")
    return f"{shared.rstrip('/')}/{name}-{uuid4().hex[:12]}"
