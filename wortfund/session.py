"""Session settings for local runs, and the shared scratch folder."""

import gc
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores="*", app="wortfund", memory="16g", **conf) -> SparkSession:
    """A local session for tests and the bench. On a cluster, spark-submit brings the session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        # Small data: pieces small enough that all cores write.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_root: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below `spark.checkpoint.dir`, the folder all executors share.

    Only a local-mode session may go without that setting: driver and executors are then one
    process, and a temporary folder of this machine serves.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        if not _local_root:
            _local_root.append(tempfile.mkdtemp(prefix="wortfund-"))
        root = _local_root[0]
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a table that was written to a scratch path."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of ended jobs deleted. Spark does so when the driver's JVM collects their plans, which a driver with little
    to do may put off for half an hour."""
    gc.collect()
    spark._jvm.System.gc()
