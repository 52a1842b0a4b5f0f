"""Session for a single machine, for tests and benchmarks."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str | None = None, partitions: int | None = None) -> SparkSession:
    cores = cores or os.environ.get("BENCH_CPUS") or 8
    spark = (SparkSession.builder.master(f"local[{cores}]").appName("ride_analytics")
             .config("spark.sql.shuffle.partitions", str(partitions or cores))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.execution.arrow.pyspark.enabled", "true")
             .config("spark.driver.memory", "12g")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
