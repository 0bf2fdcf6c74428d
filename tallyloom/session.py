"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_scratch: dict[str, str] = {}


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "tallyloom") -> SparkSession:
    """A session for tests and benchmarks.  On a cluster, build your own and leave sizing to it."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession) -> str:
    """The folder for the written intermediates of this application, below ``spark.checkpoint.dir`` of the session.

    It is named after the application, so that it can be removed when the application has ended.  Only a local session may go without the setting; it then gets a temporary folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{spark.sparkContext.applicationId}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="tallyloom-")
    return _local_scratch[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, so that later stages, and tasks rerun after
    a lost executor, start from files and always see the same rows."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
