"""Baskets of items per owner, duplicates in them, owner counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cofferline.operators.ranks import ordered_positions


def group_items(df: DataFrame, order: list[str], owner: str = "owner", item: str = "item") -> DataFrame:
    """One array of items per owner, repeats kept, in the order of the given columns."""
    ordered = F.array_sort(F.collect_list(F.struct(*order, F.col(item).alias("_item"))))
    return df.groupBy(owner).agg(
        F.transform(ordered, lambda s: s["_item"]).alias("items")
    )


def drop_repeats(baskets: DataFrame, items: str = "items") -> DataFrame:
    """Keep the first of equal items in each basket."""
    return baskets.withColumn(items, F.array_distinct(items))


def make_baskets(
    df: DataFrame, order: list[str] | None = None, owner: str = "owner", item: str = "item"
) -> DataFrame:
    """One array of distinct items per owner, by first occurrence or, without ``order``, by name.

    Repeats are merged before the arrays are built, so a busy owner ships each item once.
    """
    if order is None:
        return (
            df.select(owner, item).distinct().groupBy(owner)
            .agg(F.array_sort(F.collect_list(item)).alias("items"))
        )
    first = df.groupBy(owner, item).agg(F.min(F.struct(*order)).alias("_first"))
    ordered = F.array_sort(F.collect_list(F.struct("_first", F.col(item).alias("_item"))))
    return first.groupBy(owner).agg(F.transform(ordered, lambda s: s["_item"]).alias("items"))


def items_as_text(baskets: DataFrame, items: str = "items", separator: str = ",") -> DataFrame:
    """Basket arrays as separated text."""
    return baskets.withColumn(items, F.concat_ws(separator, F.col(items)))


def duplicate_items(df: DataFrame, order: list[str], owner: str = "owner", item: str = "item") -> DataFrame:
    """Items an owner holds more than once, with their 0-based positions in the basket.

    Works on the rows themselves; no basket array is built.
    """
    placed = ordered_positions(df.select(owner, item, *order), owner, [*order, item])
    places = F.sort_array(F.collect_list("pos")).alias("_places")
    joined = placed.groupBy(owner, item).agg(places).filter(F.size("_places") > 1)
    positions = F.array_join(F.col("_places").cast("array<string>"), ",").alias("positions")
    return joined.select(owner, item, F.size("_places").cast("long").alias("count"), positions)


def owner_count(df: DataFrame, owner: str = "owner", approximate: bool = False) -> DataFrame:
    """Number of distinct owners as a one-row table."""
    count = F.approx_count_distinct(owner) if approximate else F.countDistinct(owner)
    return df.agg(count.alias("n_owners"))
