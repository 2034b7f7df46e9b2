"""Session settings and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints: the one the cluster names, a temporary one only in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="cofferline-checkpoint-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def _stored_root(spark: SparkSession) -> str:
    ensure_checkpoint_dir(spark)
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    return f"{root.rstrip('/')}/cofferline-{context.applicationId}"


def new_folder(spark: SparkSession) -> str:
    """A folder that does not exist yet, in storage that all executors reach."""
    return f"{_stored_root(spark)}/{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet below the checkpoint folder and read it from there afterwards.

    Used for tables that several later steps read. The files live in shared storage, so a lost
    executor costs a re-read of some files and not a rerun of the plan behind them, and Spark knows
    their size, by which it chooses joins. ``drop_stored`` removes them.
    """
    folder = new_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def drop_stored(spark: SparkSession) -> None:
    """Delete all tables that ``materialise`` wrote in this application. Results that still read them
    must have been written before."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_stored_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def local_session(cores: int | str = 8, app: str = "cofferline", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
