"""Session settings and the shared folder for written intermediate tables."""

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "navlake", cpus: str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", os.environ.get("NAVLAKE_SCRATCH") or tempfile.mkdtemp(prefix="navlake-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cut_lineage(frame: DataFrame) -> DataFrame:
    """The rows of ``frame``, written once to the shared checkpoint folder and read from there.

    As Parquet, which keeps a file name that all rows of a feed share once, and of which a reader
    takes the columns it needs.
    """
    spark = frame.sparkSession
    named = None if spark.conf.get("spark.checkpoint.dir", None) else spark.sparkContext.getCheckpointDir()
    path = f"{named.rstrip('/')}/rows-{uuid.uuid4().hex}" if named else scratch_path(spark, "rows")
    frame.write.parquet(path)
    return spark.read.parquet(path)


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path for a written intermediate table.

    It lies in the folder the cluster names in ``spark.checkpoint.dir``, which every
    executor can reach. Only a local session without that setting falls back to a
    temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="navlake-")
    return f"{base.rstrip('/')}/navlake/{purpose}-{uuid.uuid4().hex}"
