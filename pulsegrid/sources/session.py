"""A local session for tests and the bench. A cluster brings its own settings."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = 8, shuffle_partitions: int = 16, memory: str = "12g", folder: str | None = None
) -> SparkSession:
    """``folder`` takes the settled tables; without it, a new temporary folder does."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pulsegrid")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.checkpoint.dir", folder or tempfile.mkdtemp(prefix="pulsegrid-"))
        .getOrCreate()
    )
