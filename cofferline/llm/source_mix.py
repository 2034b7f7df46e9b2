"""Mixing sources to target weights by entropy balancing.

Every source gets a target in words. Among all rates r of its documents, from 0 up to ``most``, whose
words reach the target, entropy balancing takes those nearest to 1 in relative entropy: the minimum
of the sum of r log r - r under sum(r * size) = target. Its rates are exponentially tilted,
r = min(most, exp(tilt * size)), and the tilts solve the convex dual. Newton steps, held inside a
bracket, find the tilts of all sources at once; every step is one aggregation over (source, size)
counts. Rates are rounded into whole copies so that the rounding error is carried from larger to
smaller documents and ends below half the smallest size that still has a rate to round.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cofferline.llm.common import stored
from cofferline.operators.ranks import global_rank

_STEPS = 200  # a bracket is halved at the latest every second step; some ten are usual
_PER_BUCKET = 20_000  # documents of one size are told apart in buckets of about so many
_COPIES = "source string, size bigint, documents bigint, copies bigint"


def word_count(text: Column) -> Column:
    """Words parted by ASCII white space; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0)) -> DataFrame:
    """(source, weight): the weights in turn, over the sources by code point, null last."""
    ranked = global_rank(sources.select("source").distinct(), F.col("source").asc_nulls_last(), rank="_pos")
    turn = F.get(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("_pos") - 1) % len(weights)).cast("int"))
    return ranked.select("source", turn.alias("weight"))


def targets(sizes: DataFrame, weights: DataFrame, most: float = 3.0) -> DataFrame:
    """(source, source_size, target): all words shared by weight, but at most ``most`` times a source.

    ``sizes`` holds (source, source_size), ``weights`` (source, weight > 0). What is above goes to the
    sources below their bound, by weight, until none is above. Only the sums of a round reach the driver.
    """
    rows = stored(
        sizes.join(weights, sizes["source"].eqNullSafe(weights["source"])).select(sizes["source"], "source_size", "weight"), "weights"
    )
    total = rows.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    bound, share = most * F.col("source_size"), math.inf
    free, left = rows.agg(F.sum("weight")).first()[0] or 0.0, float(total)
    while free:
        share, before = left / free, share
        if share == before:
            break
        full = F.col("weight") * F.lit(share) > bound
        held = rows.agg(F.sum(F.when(full, bound)), F.sum(F.when(~full, F.col("weight")))).first()
        free, left = held[1] or 0.0, float(total) - float(held[0] or 0.0)
    whole = F.lit(0.0) if math.isinf(share) else F.col("weight") * F.lit(share)
    return rows.select("source", "source_size", F.least(whole, bound.cast("double")).alias("target"))


def tilts(counts: DataFrame, wanted: DataFrame, most: float = 3.0) -> DataFrame:
    """(source, target, scale, tilt): the rate of a document is least(most, exp(tilt * size / scale)).

    ``counts`` holds (source, size, documents), ``wanted`` (source, source_size, target) with targets
    up to ``most`` times the source. Sources without words keep a tilt of 0. A step joins the counts with
    the tilts so far and sums words and their slope per source; the largest miss alone reaches the driver.
    """
    mean = counts.filter("size > 0").groupBy("source").agg((F.sum(F.col("size") * F.col("documents")) / F.sum("documents")).alias("scale"))
    top = F.log(F.lit(float(most))) * F.col("scale")  # there every document has the largest rate
    state = wanted.join(mean, wanted["source"].eqNullSafe(mean["source"]), "left").select(
        wanted["source"],
        "target",
        F.coalesce("scale", F.lit(1.0)).alias("scale"),
        F.when(F.col("target") >= most * F.col("source_size"), F.coalesce(top, F.lit(0.0))).otherwise(0.0).alias("tilt"),
        F.lit(None).cast("double").alias("low"),
        F.when(F.col("target") >= F.col("source_size"), F.coalesce(top, F.lit(0.0))).otherwise(0.0).alias("high"),
        ((F.col("target") <= 0) | (F.col("target") >= most * F.col("source_size"))).alias("done"),
    )
    for _ in range(_STEPS):
        state = stored(state, "tilts")
        if not state.filter("not done").limit(1).count():
            break
        open_ = state.filter("not done")
        rate = F.least(F.lit(float(most)), F.exp(F.col("tilt") * F.col("size") / F.col("scale")))
        words = F.col("documents") * F.col("size") * rate
        seen = (
            counts.withColumnRenamed("source", "_source")
            .join(open_, F.col("_source").eqNullSafe(F.col("source")))
            .groupBy("source")
            .agg(F.sum(words).alias("words"), F.sum(F.when(rate < most, words * F.col("size") / F.col("scale")).otherwise(0.0)).alias("slope"))
            .withColumnRenamed("source", "_source")
        )
        miss = F.col("words") - F.col("target")
        low = F.when(miss < 0, F.greatest("low", "tilt")).otherwise(F.col("low"))
        high = F.when(miss > 0, F.least("high", "tilt")).otherwise(F.col("high"))
        newton = F.when(F.col("slope") > 0, F.col("tilt") - miss / F.col("slope"))
        # a side without bound is opened by doublings until it has one
        halved = F.when(F.col("low").isNull(), F.col("high") - 2 * F.greatest(F.abs("tilt"), F.lit(1.0))).otherwise((F.col("low") + F.col("high")) / 2)
        inside = (newton < F.col("high")) & (F.col("low").isNull() | (newton > F.col("low")))
        moved = (
            open_.join(seen, F.col("source").eqNullSafe(F.col("_source")))
            .withColumn("miss", miss)
            .withColumn("low", low)
            .withColumn("high", high)
            .withColumn("next", F.when(inside, newton).otherwise(halved))
        )
        near = (F.abs("miss") <= F.greatest(F.lit(0.25), 1e-9 * F.col("target"))) | (F.col("next") == F.col("tilt"))
        moved = moved.withColumn("done", F.coalesce(near, F.lit(True))).withColumn("tilt", F.when(F.col("done"), F.col("tilt")).otherwise(F.col("next")))
        state = state.filter("done").unionByName(moved.select(state.columns))
    return state.select("source", "target", "scale", "tilt")


def _round(most: int):
    def rounded(key: tuple, table: pa.Table) -> pa.Table:
        """Whole copies for all documents of one size, from the largest size down; what a size gets too
        much or too little is carried to the next."""
        order = np.argsort(-table["size"].to_numpy())
        sizes, documents, rates = (table[name].to_numpy()[order] for name in ("size", "documents", "rate"))
        copies = np.zeros(len(sizes), np.int64)
        carried = float(table["target"][0].as_py()) - float((sizes * documents * rates).sum())
        for n, (size, count, rate) in enumerate(zip(sizes.tolist(), documents.tolist(), rates.tolist(), strict=True)):
            if size:
                wanted = count * rate + carried / size
                copies[n] = min(max(round(wanted), 0), most * count)
                carried = (wanted - int(copies[n])) * size
        names = pa.array([key[0].as_py()] * len(sizes), pa.string())
        return pa.table({"source": names, "size": sizes, "documents": documents, "copies": copies})

    return rounded


def mix(
    docs: DataFrame,
    weights: DataFrame | tuple[float, ...] = (1.0, 2.0, 3.0),
    most: int = 3,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """How often a mix takes every document: the key, source, size, source_size, target and
    copies, whole numbers up to ``most``; the mix takes copies * size words.

    ``weights`` is a table (source, weight) or weights in turn (see ``cyclic_weights``); the words of
    all sources are shared by them (see ``targets``). A null source is a source. Null, empty and blank
    texts have size 0 and no copies. Repeated rows count each and are told apart by nothing, so some may
    get one copy more than others. Equal runs give equal copies: which documents of a size get one more
    follows a hash of key and text. An empty table gives an empty one; other columns take no part.

    Rounding reads one row per size of a source at a time. Distinct sizes sum to no more than the
    words W of the source, so there are fewer than sqrt(2 W) of them, however many documents.
    """
    hashed = F.xxhash64(F.col(key).cast("string"), F.coalesce(F.col(text), F.lit("")))
    narrow = stored(
        docs.select(F.col(key).alias("key"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"), hashed.alias("hash")),
        "sizes",
    )
    counts = stored(narrow.groupBy("source", "size").agg(F.count("*").alias("documents")), "counts")
    sizes = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("documents")).alias("source_size"))
    given = weights if isinstance(weights, DataFrame) else cyclic_weights(sizes, weights)
    wanted = stored(targets(sizes, given, most), "targets")
    tilted = tilts(counts, wanted, most).withColumnRenamed("source", "_source")
    rate = F.least(F.lit(float(most)), F.exp(F.col("tilt") * F.col("size") / F.col("scale")))
    rated = counts.join(tilted, F.col("source").eqNullSafe(F.col("_source"))).withColumn("rate", F.when(F.col("target") > 0, rate).otherwise(0.0))
    rated = stored(rated.select("source", "size", "documents", "rate", "target"), "rates")
    chosen = rated.select("source", "size", "documents", "rate", "target").groupBy("source").applyInArrow(_round(most), _COPIES)
    # documents of one size: the first ones by hash get one copy more; ranks are taken in buckets
    number = F.ceil(F.col("documents") / _PER_BUCKET)
    sides = chosen.join(wanted.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    sides = stored(sides.withColumnRenamed("source", "_source").withColumnRenamed("size", "_size").withColumn("buckets", number), "copies")
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size"))
    dealt = narrow.join(sides, same).drop("_source", "_size").withColumn("bucket", F.pmod("hash", F.col("buckets")))
    group = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        dealt.groupBy("source", "size", "bucket")
        .agg(F.count("*").alias("n"))
        .select("source", "size", "bucket", F.coalesce(F.sum("n").over(group), F.lit(0)).alias("before"))
    )
    before = before.select(*[F.col(c).alias(f"_{c}") for c in before.columns])
    within = F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("hash", "key"))
    placed = dealt.withColumn("within", within).join(
        before, F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size")) & (F.col("bucket") == F.col("_bucket"))
    )
    extra = (F.col("_before") + F.col("within") <= F.col("copies") % F.col("documents")).cast("long")
    each = F.expr("copies div documents") + extra
    return placed.select(F.col("key").alias(key), "source", "size", "source_size", "target", each.alias("copies"))
