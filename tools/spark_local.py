"""Local session used by tests, tools and the benchmark."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "8", shuffle_partitions: int = 8) -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="roadlens-run-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("roadlens")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("ROADLENS_DRIVER_MEM", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .config("spark.driver.extraJavaOptions", f"-Dderby.system.home={scratch}")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
