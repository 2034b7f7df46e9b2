"""Positions and ranks that no single task has to compute alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cofferline.session import materialise

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition number above this bit


def global_rank(df: DataFrame, *order: Column, rank: str = "pos") -> DataFrame:
    """Number all rows from 1 in the given order, which must be total.

    A distributed sort gives every partition a contiguous range; row numbers inside a partition
    plus the sizes of the partitions before it make the rank. The sorted rows are written once,
    because ids given after a sort may differ between two runs of the same plan.
    """
    ids = materialise(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", _ROW_BITS)
    sizes = ids.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = sizes.withColumn(
        "_before",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ),
    ).drop("_n")
    row = F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        ids.withColumn("_part", part)
        .join(before, "_part")
        .withColumn(rank, (F.col("_before") + row + 1).cast("long"))
        .drop("_part", "_id", "_before")
    )


def hash_rank(df: DataFrame, hex_text: Column, rank: str = "pos", digits: int = 3) -> DataFrame:
    """Number all rows from 1 by a hex digest, bucketed by its first digits.

    Digests spread evenly, so the buckets are alike in size and each is ranked on its own; only
    the 16**digits bucket sizes are summed in one place.
    """
    keyed = df.withColumn("_hex", hex_text).withColumn("_bucket", F.substring("_hex", 1, digits))
    sizes = keyed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = sizes.select(
        "_bucket",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_before"),
    )
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hex"))
    return (
        keyed.withColumn("_within", within)
        .join(before, "_bucket")
        .withColumn(rank, (F.col("_before") + F.col("_within")).cast("long"))
        .drop("_hex", "_bucket", "_within", "_before")
    )


def ordered_positions(df: DataFrame, owner: str, order: list[str], position: str = "pos") -> DataFrame:
    """0-based position of each row within its owner, in the order of the given columns, of any type.

    Rows are sorted by owner and order in ranges, so a busy owner spreads over several tasks; its rows
    in a range are shifted by those in the ranges before. Rows that tie go by a hash of all columns, by
    which a range can end between them. The sorted rows are written once, because ids given after a
    sort may differ between two runs of the same plan.
    """
    tie = F.xxhash64(*df.columns)
    rows = df.orderBy(owner, *order, tie).withColumn("_id", F.monotonically_increasing_id())
    ids = materialise(rows.withColumn("_part", F.shiftright("_id", _ROW_BITS)))
    spans = ids.groupBy(owner, "_part").agg(F.min("_id").alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy(owner).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        F.col(owner).alias("_owner"),
        F.col("_part").alias("_span"),
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    placed = ids.join(spans, F.col(owner).eqNullSafe(F.col("_owner")) & (F.col("_part") == F.col("_span")))
    return placed.withColumn(position, F.col("_id") + F.col("_shift")).drop("_id", "_part", "_owner", "_span", "_shift")


def top_per_owner(df: DataFrame, n: int, owner: str = "owner", score: str = "score", item: str = "item") -> DataFrame:
    """Best ``n`` rows per owner by score, ties by item, with their rank from 1.

    Spark keeps the first ``n`` of each owner per input partition before it shuffles.
    """
    order = Window.partitionBy(owner).orderBy(F.col(score).desc(), F.col(item))
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
