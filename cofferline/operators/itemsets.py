"""Exact frequent itemsets: all item combinations in at least ``n * min_support`` baskets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cofferline.session import materialise

_BITMAP_BYTES = 4096  # fixed: size of the bitmaps that Spark's aggregates make
_BITMAP_ROWS = 500  # rows of two bitmaps that are intersected together
_PART_SETS = 20_000  # candidates that meet the bitmaps of one bucket in one task
_FEW_ITEMS = 4_096  # items whose bitmaps of one bucket a task holds together
_CHUNK_BASKETS = 50_000  # baskets mined together in the two-pass operator


def _grow(baskets: DataFrame, rows: int, items: str, min_count: int) -> DataFrame:
    if rows == 0:
        return baskets.sparkSession.createDataFrame([], "items array<string>, freq bigint")
    # half a basket below the threshold: the product rounds up to exactly min_count
    share = max(min_count - 0.5, 0.5) / rows
    model = FPGrowth(itemsCol=items, minSupport=min(share, 1.0)).fit(baskets)
    return model.freqItemsets.select(F.array_sort("items").alias("items"), "freq")


def _threshold(n_baskets: int, min_support: float) -> int:
    return max(math.ceil(n_baskets * min_support), 1)


def frequent_itemsets(
    baskets: DataFrame, min_support: float, items: str = "items", n_baskets: int | None = None
) -> DataFrame:
    """Frequent itemsets of basket arrays as (items, freq), items sorted.

    ``n_baskets`` is the number the support refers to, the row count when not given. Baskets are written
    once, as counting and growing read them several times.
    """
    sets = materialise(baskets.select(F.array_distinct(items).alias("items")))
    rows = sets.count()
    return _grow(sets, rows, "items", _threshold(rows if n_baskets is None else n_baskets, min_support))


def frequent_items(
    holdings: DataFrame, min_count: float, owner: str = "owner", item: str = "item"
) -> DataFrame:
    """Items held by at least ``min_count`` owners, as (item, freq). Rows must be distinct."""
    return (
        holdings.groupBy(F.col(item).alias("item"))
        .agg(F.count("*").alias("freq"))
        .filter(F.col("freq") >= F.lit(float(min_count)))
    )


def frequent_pairs(
    holdings: DataFrame, min_support: float, owner: str = "owner", item: str = "item"
) -> tuple[DataFrame, DataFrame, int]:
    """Distinct (owner, item) rows of the frequent items, those items as (item, freq), and the number
    of all owners. An infrequent item is in no frequent itemset."""
    pairs = materialise(
        holdings.select(F.col(owner).alias("owner"), F.col(item).alias("item")).distinct()
    )
    n_owners = pairs.agg(F.countDistinct("owner")).first()[0]
    singles = materialise(frequent_items(pairs, n_owners * min_support))
    return pairs.join(singles.select("item"), "item", "left_semi"), singles, n_owners


def frequent_itemsets_of_holdings(
    holdings: DataFrame, min_support: float, owner: str = "owner", item: str = "item"
) -> tuple[DataFrame, int]:
    """Frequent itemsets straight from (owner, item) rows, and the number of owners.

    Found level by level from owner bitmaps, as by ``levelwise_itemsets``; no basket array is built.
    """
    pairs, singles, n_owners = frequent_pairs(holdings, min_support, owner, item)
    return _by_level(pairs, singles, _threshold(n_owners, min_support)), n_owners


# -- level by level ---------------------------------------------------------------------------


def candidate_sets(level: DataFrame) -> DataFrame:
    """Sets one item larger than those of ``level`` all of whose subsets are in ``level``.

    Two sets that agree in all but their last item make a candidate; every set of the next level
    has exactly one such pair among its subsets.
    """
    cut = F.slice("items", F.lit(1), F.size("items") - 1)
    last = F.element_at("items", -1)
    left = level.select(cut.alias("_stem"), last.alias("_a"))
    right = level.select(cut.alias("_stem"), last.alias("_b"))
    joined = (
        left.join(right, "_stem")
        .filter(F.col("_a") < F.col("_b"))
        .select(F.concat("_stem", F.array("_a", "_b")).alias("items"))
    )
    return prune_candidates(joined, level)


def prune_candidates(candidates: DataFrame, level: DataFrame) -> DataFrame:
    """Keep the candidates whose every subset one item smaller is in ``level``."""
    subsets = candidates.withColumn("_out", F.explode("items")).select(
        F.col("items").alias("_candidate"),
        F.expr("filter(items, x -> x <> _out)").alias("items"),
    )
    return (
        subsets.join(level.select("items"), "items", "left_semi")
        .groupBy("_candidate")
        .agg(F.count("*").alias("_hits"))
        .filter(F.col("_hits") == F.size("_candidate"))
        .select(F.col("_candidate").alias("items"))
    )


def owner_bitmaps(pairs: DataFrame) -> DataFrame:
    """(items, bucket, bits): one bitmap row per item and 32768 owner numbers.

    ``pairs`` are distinct (owner, item) rows. Owners are numbered in a stored table, so a repeated
    task sees the same numbers; numbers within a partition of it follow each other.
    """
    owners = materialise(pairs.select("owner").distinct().withColumn("_no", F.monotonically_increasing_id()))
    place = F.bitmap_bit_position(F.col("_no") + 1)
    return (
        pairs.join(owners, "owner")
        .groupBy(F.array("item").alias("items"), F.bitmap_bucket_number(F.col("_no") + 1).alias("bucket"))
        .agg(F.bitmap_construct_agg(place).alias("bits"))
    )


def _common_owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The owners that both bitmaps of a row hold, and their number, a few bitmaps at a time."""
    for batch in batches:
        for first in range(0, len(batch), _BITMAP_ROWS):
            part = batch.slice(first, _BITMAP_ROWS)
            left, right = (
                np.frombuffer(b"".join(part.column(name).to_pylist()), np.uint8).reshape(-1, _BITMAP_BYTES)
                for name in ("_left", "_right")
            )
            both = left & right
            found = np.bitwise_count(both).sum(axis=1, dtype=np.int64)
            some = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("items").take(pa.array(some)),
                    part.column("bucket").take(pa.array(some)),
                    pa.array([row.tobytes() for row in both[some]], pa.binary()),
                    pa.array(found[some]),
                ],
                ["items", "bucket", "bits", "n"],
            )


def shared_owners(candidates: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """(items, bucket, bits, n): owners of each candidate, from the bitmaps of two of its subsets.

    The subsets are those without the last and without the last but one item; both are sets of the
    level before. Buckets without a common owner have no row.
    """
    stem = F.slice("items", F.lit(1), F.size("items") - 2)
    parents = candidates.select(
        "items",
        F.concat(stem, F.array(F.element_at("items", -2))).alias("_first"),
        F.concat(stem, F.array(F.element_at("items", -1))).alias("_second"),
    )
    left = bitmaps.select(F.col("items").alias("_first"), "bucket", F.col("bits").alias("_left"))
    right = bitmaps.select(F.col("items").alias("_second"), "bucket", F.col("bits").alias("_right"))
    pairs = parents.join(left, "_first").join(right, ["_second", "bucket"])
    schema = "items array<string>, bucket long, bits binary, n long"
    return pairs.select("items", "bucket", "_left", "_right").mapInArrow(_common_owners, schema)


def levelwise_itemsets(
    baskets: DataFrame, min_support: float, items: str = "items", n_baskets: int | None = None
) -> DataFrame:
    """The result of ``frequent_itemsets`` found level by level.

    A level's candidates stay a table; each is counted by intersecting the owner bitmaps of two of
    its subsets, bucket by bucket.
    """
    sets = baskets.select(F.array_distinct(items).alias("items"))
    if n_baskets is None:
        n_baskets = sets.count()
    min_count = _threshold(n_baskets, min_support)
    numbered = materialise(sets.withColumn("owner", F.monotonically_increasing_id()))
    pairs = numbered.select("owner", F.explode("items").alias("item"))
    singles = materialise(frequent_items(pairs, min_count))
    return _by_level(pairs.join(singles.select("item"), "item", "left_semi"), singles, min_count)


def _by_level(pairs: DataFrame, singles: DataFrame, min_count: int) -> DataFrame:
    """All levels over distinct (owner, item) rows of the frequent items.

    Where items are few, every level is counted from the bitmaps of its items; else the bitmaps of a level are
    written for the next one."""
    found = level = singles.select(F.array("item").alias("items"), "freq")
    bitmaps = materialise(owner_bitmaps(pairs))
    few = bitmaps.select(F.col("items")[0].alias("item"), "bucket", "bits") if singles.count() <= _FEW_ITEMS else None
    while True:
        candidates = materialise(candidate_sets(level))
        if candidates.isEmpty():
            return found
        shared = None if few else materialise(shared_owners(candidates, bitmaps))
        counts = _counted(candidates, few) if few else shared.groupBy("items").agg(F.sum("n").alias("freq"))
        level = materialise(counts.filter(F.col("freq") >= min_count))
        if level.isEmpty():
            return found
        found = found.unionByName(level)
        if shared:
            bitmaps = shared.join(level.select("items"), "items", "left_semi").select("items", "bucket", "bits")


# -- two passes -------------------------------------------------------------------------------


def local_itemsets(baskets: list[list[str]], min_count: int) -> Iterator[tuple[str, ...]]:
    """All sets in at least ``min_count`` of a few baskets, grown depth first from bitmaps of basket
    numbers; a bitmap is one whole number."""
    held: dict[str, int] = {}
    for place, basket in enumerate(baskets):
        for item in basket:
            held[item] = held.get(item, 0) | 1 << place
    first = [(item, bits) for item, bits in sorted(held.items()) if bits.bit_count() >= min_count]
    waiting = [((), first)]
    while waiting:
        stem, tails = waiting.pop()
        for place, (item, bits) in enumerate(tails):
            found = (*stem, item)
            yield found
            longer = [(other, both) for other, more in tails[place + 1 :] if (both := bits & more).bit_count() >= min_count]
            if longer:
                waiting.append((found, longer))


def _mine_chunk(n_rows: int, min_count: int):
    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        baskets = [sorted(set(basket)) for batch in batches for basket in batch.column(0).to_pylist()]
        scaled = max(-(-min_count * len(baskets) // n_rows), 1)  # rounded up
        names = pa.list_(pa.string())
        waiting = []
        for found in local_itemsets(baskets, scaled):
            waiting.append(found)
            if len(waiting) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(waiting, names)], ["items"])
                waiting = []
        yield pa.RecordBatch.from_arrays([pa.array(waiting, names)], ["items"])

    return mine


def _count_part(sets: pa.Table, bitmaps: pa.Table) -> pa.Table:
    """(items, n): owners of each set within one bucket, by intersecting the bitmaps of its items.

    Sets are taken in their order, so those with a common beginning intersect it once."""
    held = dict(zip(bitmaps["item"].to_pylist(), bitmaps["bits"].to_pylist()))
    empty = np.zeros(_BITMAP_BYTES, np.uint8)
    wanted = sorted(sets["items"].to_pylist()) if held else []
    counts, path, common = [], [], []
    for items in wanted:
        shared = 0
        while shared < min(len(path), len(items)) and path[shared] == items[shared]:
            shared += 1
        del path[shared:], common[shared:]
        for item in items[shared:]:
            bits = np.frombuffer(held[item], np.uint8) if item in held else empty
            common.append(common[-1] & bits if common else bits)
            path.append(item)
        counts.append(int(np.bitwise_count(common[-1].view(np.uint64)).sum(dtype=np.int64)))
    return pa.table({"items": pa.array(wanted, pa.list_(pa.string())), "n": pa.array(counts, pa.int64())})


def count_itemsets(pairs: DataFrame, candidates: DataFrame) -> DataFrame:
    """(items, freq): how many owners of the (owner, item) rows hold each candidate, a sorted array.

    Candidates are dealt to parts by their first two items, of some ``_PART_SETS`` each, and every part meets
    the bitmaps of its items bucket by bucket; a bitmap takes a bit per owner, and no basket is looked at by itself.
    """
    sets = materialise(candidates.select("items").distinct())
    wanted = materialise(sets.select(F.explode("items").alias("item")).distinct())
    kept = pairs.select("owner", "item").join(wanted, "item", "left_semi").distinct()
    bitmaps = materialise(owner_bitmaps(kept).select(F.col("items")[0].alias("item"), "bucket", "bits"))
    return _counted(sets, bitmaps)


def _counted(sets: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """(items, freq) of stored distinct sets by the stored (item, bucket, bits)."""
    parts = max(-(-sets.count() // _PART_SETS), 1)
    part = F.pmod(F.xxhash64(F.slice("items", 1, 2)), F.lit(parts)).cast("int")
    sets = sets.withColumn("_part", part)
    wanted = materialise(sets.select("_part", F.explode("items").alias("item")).distinct())
    buckets = bitmaps.select(F.col("bucket").alias("bucket")).distinct()
    left = sets.select("items", "_part").crossJoin(buckets).groupBy("_part", "bucket")
    right = bitmaps.join(wanted, "item").groupBy("_part", "bucket")
    counted = left.cogroup(right).applyInArrow(_count_part, "items array<string>, n long")
    return counted.groupBy("items").agg(F.sum("n").alias("freq"))


def two_pass_itemsets(
    baskets: DataFrame,
    min_support: float,
    items: str = "items",
    n_baskets: int | None = None,
    chunks: int | None = None,
) -> DataFrame:
    """The result of ``frequent_itemsets`` in two passes over the baskets.

    The first pass mines chunks of baskets by themselves, at the threshold scaled to their size: a
    set that is frequent in all baskets is so in one chunk at least. The second counts the sets so
    found in all baskets. Candidates stay a table between the passes. ``chunks`` is their number; by
    default one holds some ten thousand baskets, as thresholds of small chunks let chance sets through.
    """
    distinct = F.array_sort(F.array_distinct(items)).alias("items")
    sets = materialise(baskets.select(F.monotonically_increasing_id().alias("owner"), distinct))
    rows = sets.count()
    n_baskets = rows if n_baskets is None else n_baskets
    min_count = _threshold(n_baskets, min_support)
    if not rows:
        return sets.select("items", F.lit(0).cast("long").alias("freq"))
    dealt = sets.select("items").repartition(chunks or -(-rows // _CHUNK_BASKETS))
    local = dealt.mapInArrow(_mine_chunk(rows, min_count), "items array<string>")
    candidates = materialise(local.distinct())
    pairs = sets.select("owner", F.explode("items").alias("item"))
    return count_itemsets(pairs, candidates).filter(F.col("freq") >= min_count)
