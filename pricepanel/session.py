"""Spark session helpers.

The library never creates a session behind the caller's back; ``get_session``
is a convenience for scripts and tests.  Cluster settings (shuffle partitions,
checkpoint directory) are read from the running session when present.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # partition-column values like 2023_01 must stay strings
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "pricepanel", extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app_name).master(master or f"local[{cpus}]")
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf["spark.driver.memory"] = os.environ.get("PRICEPANEL_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Without that setting only a local master may go on (all tasks share this machine's disk): it gets a
    private scratch folder.  On a cluster executors would write to disks of their own, so it is an error.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="pricepanel-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def _scratch(spark: SparkSession) -> str:
    """This application's folder for tables written in between."""
    return f"{checkpoint_dir(spark).rstrip('/')}/pricepanel-tables/{spark.sparkContext.applicationId}"


def cut_lineage(df, name: str = "table"):
    """Cut lineage through a parquet table written once into the shared checkpoint folder.

    Unlike ``Dataset.checkpoint(eager=True)`` (one job to count, a second one to write the
    checkpoint files) the plan runs once, survives executor loss, and the read-back gets column
    pruning and filter pushdown.  Never ``localCheckpoint``.  ``drop_scratch`` removes the tables.
    """
    spark = df.sparkSession
    path = f"{_scratch(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Remove this application's tables written in between; frames that read them end with it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
