"""Association rules with any number of items on both sides, and threshold grids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cofferline.session import materialise

# The thresholds that reports are cut at.
SUPPORT_GRID = [
    0.05, 0.06, 0.07, 0.08, 0.09, 0.10, 0.11, 0.12, 0.13, 0.14, 0.15, 0.16, 0.17, 0.18, 0.19, 0.20,
]
CONFIDENCE_GRID = [0.5, 0.6, 0.7, 0.8]


def association_rules(itemsets: DataFrame, n_baskets: int, min_confidence: float) -> DataFrame:
    """Rules X -> Y over all splits of each frequent itemset, with confidence > ``min_confidence``.

    ``itemsets`` must hold every frequent itemset, items sorted, as all its subsets are looked up in
    it. Consequents grow by one item a step. A longer consequent leaves a shorter antecedent, which
    is at least as frequent, so confidence never rises and only rules that were kept are extended.
    """
    longest = itemsets.agg(F.max(F.size("items"))).first()[0] or 0
    left = itemsets.select(F.col("items").alias("antecedent"), F.col("freq").alias("_left"))
    right = itemsets.select(F.col("items").alias("consequent"), F.col("freq").alias("_right"))
    n = F.lit(float(n_baskets))
    splits = itemsets.filter(F.size("items") > 1).select(
        "items", F.col("freq").alias("_both"), F.explode("items").alias("_item")
    ).select("items", "_both", F.array("_item").alias("consequent"))
    steps = []
    for _ in range(1, max(longest, 2)):
        kept = materialise(
            splits.withColumn("antecedent", F.array_except("items", "consequent"))
            .join(left, "antecedent")
            .withColumn("confidence", F.col("_both") / F.col("_left").cast("double"))
            .filter(F.col("confidence") > F.lit(float(min_confidence)))
            .select("items", "_both", "antecedent", "consequent", "confidence")
        )
        steps.append(kept)
        if kept.isEmpty():
            break
        # items are added in order, so that every consequent is made once
        later = F.filter("items", lambda x: x > F.element_at("consequent", -1))
        splits = (
            kept.filter(F.size("antecedent") > 1)
            .select("items", "_both", "consequent", F.explode(later).alias("_item"))
            .select("items", "_both", F.concat("consequent", F.array("_item")).alias("consequent"))
        )
    return reduce(DataFrame.unionByName, steps).join(right, "consequent").select(
        "antecedent",
        "consequent",
        "confidence",
        (F.col("confidence") / (F.col("_right") / n)).alias("lift"),
        (F.col("_both") / n).alias("support"),
    )


def itemset_grid(
    itemsets: DataFrame, n_baskets: int, supports: list[float] = SUPPORT_GRID
) -> DataFrame:
    """Itemsets repeated for every support threshold they reach, with ``min_support``."""
    reached = F.filter(
        F.array(*[F.lit(float(s)) for s in supports]),
        lambda s: F.col("freq") >= s * F.lit(float(n_baskets)),
    )
    return itemsets.withColumn("min_support", F.explode(reached))


def rule_grid(
    rules: DataFrame,
    supports: list[float] = SUPPORT_GRID,
    confidences: list[float] = CONFIDENCE_GRID,
) -> DataFrame:
    """Rules repeated for every threshold pair they reach, with ``min_support``, ``min_confidence``."""
    by_support = F.filter(
        F.array(*[F.lit(float(s)) for s in supports]), lambda s: F.col("support") >= s
    )
    by_confidence = F.filter(
        F.array(*[F.lit(float(c)) for c in confidences]), lambda c: F.col("confidence") >= c
    )
    return rules.withColumn("min_support", F.explode(by_support)).withColumn(
        "min_confidence", F.explode(by_confidence)
    )


def by_frequency(itemsets: DataFrame) -> DataFrame:
    """Itemsets, most frequent first."""
    return itemsets.orderBy(F.desc("freq"), "items")


def by_confidence(rules: DataFrame) -> DataFrame:
    """Rules, most confident first."""
    return rules.orderBy(F.desc("confidence"), F.desc("lift"), "antecedent", "consequent")
