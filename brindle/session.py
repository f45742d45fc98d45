"""Session defaults and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on. AQE splits skewed join partitions and coalesces small ones.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


# Spark removes the shuffle files of a query when it has ended, not when the driver happens to collect its garbage.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(app: str = "brindle", cores: str | int = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    local = {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false"}
    for name, value in {**DEFAULTS, **local, **conf}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only on a local master."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="brindle-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder. All paths of an application are below one folder, which may
    be deleted when the application has ended."""
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark).rstrip('/')}/brindle-{application}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives Catalyst the true size of
    the data: a join against a settled side is broadcast only if its files are below
    ``spark.sql.autoBroadcastJoinThreshold`` and is a sort-merge join (with AQE skew handling)
    otherwise. What was shuffled for it is removed: nothing reads it again.
    """
    path = shared_path(df.sparkSession, label)
    # Read once or twice and never removed before the application ends, so size counts more than speed.
    conf = df.sparkSession.conf
    before = conf.get(REMOVE_SHUFFLES, "false")
    conf.set(REMOVE_SHUFFLES, "true")
    try:
        df.write.mode("error").option("compression", "zstd").parquet(path)
    finally:
        conf.set(REMOVE_SHUFFLES, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)
