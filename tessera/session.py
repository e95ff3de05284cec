"""Session helpers: a local session for tests and benches, and the checkpoint folder.

Operators never create sessions; they take the one their input DataFrame lives in.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tessera") -> SparkSession:
    """Session for tests and the bench: AQE on, UI off, UTC, Arrow on."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only in local mode.

    On a cluster the folder is the shared one named by ``spark.checkpoint.dir``
    (Spark applies it when the context starts). Only a ``local[...]`` session
    without that setting gets a scratch folder under the system temp folder;
    anywhere else a missing setting is an error, because a machine-local folder
    does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a shared folder: iterative operators cut "
            "their lineage with reliable checkpoints")
    path = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(path)
    return path


def scan_partitions(df: DataFrame) -> int | None:
    """Partitions of a plan without exchanges; None for others, whose shuffles would run as a job of their own to tell."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return None if "Exchange" in plan else df.rdd.getNumPartitions()


def write_table(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` written to the shared checkpoint folder and reread, and its path: the lineage ends here."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a written table that nothing reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
