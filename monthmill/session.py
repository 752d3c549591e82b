"""A local session for tests and the bench, and the folder jobs may write intermediate tables to.

On a cluster the session is the cluster's own; nothing in the library sets cluster options.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import SparkSession


def local_session(
    app: str, cores: int = 8, memory: str = "12g", warehouse: str | None = None
) -> SparkSession:
    """``warehouse`` is where managed tables go, by default a folder below the working directory."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if warehouse is not None:
        builder = builder.config("spark.sql.warehouse.dir", warehouse)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder of ``spark.checkpoint.dir``, or else below the warehouse.

    What is written there goes when the driver ends, if the application still runs by then.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if not _scratch:
        atexit.register(_clear)
    _scratch.append((spark, spark.sparkContext.applicationId, path))
    return path


_scratch: list[tuple[SparkSession, str, str]] = []


def _clear() -> None:
    for spark, application, path in _scratch:
        context = spark.sparkContext
        if context._jsc is not None and context.applicationId == application:
            folder = context._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
