"""Session building and durable scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Wide projections compile to methods the JIT refuses; below this size Spark splits them instead.
WIDE_SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, driver_memory: str = "8g", **extra) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("leadforge")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.files.openCostInBytes", str(512 * 1024))  # small test files still use all cores
    )
    for key, value in {**WIDE_SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Where the setting is absent, a session on one machine (tests, the benchmark) gets a temporary folder;
    a cluster has to name one, since a folder of the driver's machine would be of no use to executors.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="leadforge-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, for written intermediate tables and exchange files."""
    return f"{shared_dir(spark)}/leadforge-scratch/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Materialise a frame in the shared folder, so that a lost executor cannot change it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
