"""Tables published as a whole: attempts in folders of their own, and a manifest that names the current one.

A reader sees the last attempt whose manifest is written, all of it or none. Attempts that failed, or
were replaced, leave files that nothing reads; ``drop_old_attempts`` removes them. Cells of a grid are
partition folders, so a reader of one cell reads its files alone, and cells without rows in a new
attempt do not keep those of an older one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MANIFEST = "attempt string, number long, n_rows long, n_cells long, columns array<string>"


def _folders(spark: SparkSession, folder: str, prefix: str) -> list:
    """Paths of sub-folders by their names, which sort in the order of writing."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = store.listStatus(path) if store.exists(path) else []
    return sorted(
        (status.getPath() for status in found if status.isDirectory() and status.getPath().getName().startswith(prefix)),
        key=lambda path: path.getName(),
    )


def _complete(spark: SparkSession, folder: str) -> list[str]:
    """Manifest folders that Spark has committed, oldest first."""
    out = []
    for path in _folders(spark, folder, "manifest-"):
        store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if store.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")):
            out.append(path.toString())
    return out


def publish(df: DataFrame, folder: str, cells: list[str]) -> None:
    """Write ``df`` as the current table of ``folder``, one partition folder per value of ``cells``."""
    spark = df.sparkSession
    manifests = _complete(spark, folder)
    number = int(manifests[-1].rpartition("-")[2]) + 1 if manifests else 0
    attempt = f"attempt-{number:08d}-{uuid.uuid4().hex}"
    df.write.partitionBy(*cells).parquet(f"{folder}/{attempt}")
    written = spark.read.schema(df.schema).parquet(f"{folder}/{attempt}")
    n_rows, n_cells = written.agg(F.count("*"), F.count_distinct(F.struct(*cells))).first()
    manifest = spark.createDataFrame([(attempt, number, n_rows, n_cells, df.columns)], _MANIFEST)
    # two writers of one number cannot both succeed: the folder must be new
    manifest.coalesce(1).write.mode("errorifexists").parquet(f"{folder}/manifest-{number:08d}")


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row: attempt, number, n_rows, n_cells and columns of the current table."""
    manifests = _complete(spark, folder)
    if not manifests:
        raise FileNotFoundError(f"nothing is published in {folder}")
    return spark.read.schema(_MANIFEST).parquet(manifests[-1])


def read_published(spark: SparkSession, folder: str, schema: str | None = None) -> DataFrame:
    """The current table, its columns in the order they were written. Without rows it has no cells to
    read a schema from, so ``schema`` names the columns of a table that may be empty."""
    row = manifest(spark, folder).first()
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{folder}/{row['attempt']}").select(row["columns"])


def drop_old_attempts(spark: SparkSession, folder: str) -> None:
    """Delete all attempts and manifests but the current ones. Readers of older ones must be done."""
    current = manifest(spark, folder).first()
    manifests = _complete(spark, folder)
    for path in _folders(spark, folder, "attempt-") + _folders(spark, folder, "manifest-"):
        kept = path.getName() == current["attempt"] or path.toString() == manifests[-1]
        if not kept:
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
