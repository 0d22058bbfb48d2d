"""A local session for tests, comparisons and timings."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

from tapewright.session import RECOMMENDED_CONF


ROOT = Path(__file__).resolve().parent.parent


def local_session(cores: str | None = None) -> SparkSession:
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tapewright")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.executorEnv.PYTHONPATH", str(ROOT))
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
