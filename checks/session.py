"""A local session for tests, checks and timings."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(name: str, cpus: int | str | None = None) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName(name)
             .config("spark.sql.shuffle.partitions", str(cpus))
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.host", "127.0.0.1")
             .config("spark.driver.bindAddress", "127.0.0.1")
             .config("spark.driver.memory", "8g")
             .config("spark.ui.enabled", "false")
             # Recording the call site of every Column slows plan building by a quarter.
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
