"""A session for local runs and tests; on a cluster use the session it gives you."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: str | int = 8, **settings: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("meterbook")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
