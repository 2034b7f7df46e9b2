"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import sys
import types
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cofferline.session import ensure_checkpoint_dir

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; only Spark reads the path."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staging_folder(spark: SparkSession, what: str) -> str:
    """A new folder below the shared checkpoint folder, which every executor can reach."""
    ensure_checkpoint_dir(spark)
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    return f"{root.rstrip('/')}/cofferline-{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it from there.

    This cuts the lineage: a lost executor costs a re-read of some files, not the plan behind them.
    """
    folder = staging_folder(df.sparkSession, what)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def values_of(column, rows: int = 500):
    """Python values of an Arrow column; only some rows at a time are held as such."""
    for at in range(0, len(column), rows):
        yield from column.slice(at, rows).to_pylist()


def worker_memory(key: str, build):
    """What ``build`` makes, kept for later tasks of the same Python worker. Only for memories whose
    loss changes nothing: a new worker starts with an empty one."""
    name = "_cofferline_worker"
    kept = sys.modules.setdefault(name, types.ModuleType(name))
    if not hasattr(kept, key):
        setattr(kept, key, build())
    return getattr(kept, key)


def smallest_reachable(edges: DataFrame, low: str, high: str) -> DataFrame:
    """For every node of ``edges`` (two bigint columns): ``node``, and ``root``, the smallest node it reaches.

    Alternates two steps until nothing changes: every node links its larger neighbours to its
    smallest neighbour, then its smaller ones and itself. Both keep the components and shorten
    paths, so the number of rounds grows with the logarithm of the longest path. No component is
    ever gathered; edges stay in shared storage between rounds. Edges with a null end, and loops, are
    left out. An empty table gives an empty result.
    """
    pairs = (
        edges.select(F.col(low).cast("bigint").alias("a"), F.col(high).cast("bigint").alias("b"))
        .filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    pairs = stored(pairs, "edges")
    total = _signature(pairs)
    while total[0]:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        large = large.filter("a <> b").distinct()
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_least, "a")
        small = (
            small.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(small.select("a", F.col("m").alias("b")))
            .filter("a <> b")
            .distinct()
        )
        pairs = stored(small, "edges")
        now = _signature(pairs)
        if now == total:
            break
        total = now
    roots = pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("root"))
    ).groupBy("node").agg(F.min("root").alias("root"))


def _signature(pairs: DataFrame) -> tuple[int, int]:
    row = pairs.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
    return int(row[0]), int(row[1])
