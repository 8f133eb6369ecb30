"""Local session for tests."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: str = "8", partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("callgrove")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
