"""A local session for tests and the bench. On a cluster the caller brings the session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(name: str, cpus: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    settings = {
        "spark.sql.shuffle.partitions": str(cpus), "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false",
        "spark.driver.memory": memory, "spark.sql.adaptive.enabled": "true", "spark.ui.showConsoleProgress": "false",
    }
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
