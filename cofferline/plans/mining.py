"""Mine once at the lowest thresholds, then cut the result at every higher one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cofferline.operators.itemsets import frequent_itemsets_of_holdings
from cofferline.operators.rules import (
    CONFIDENCE_GRID,
    SUPPORT_GRID,
    association_rules,
    itemset_grid,
    rule_grid,
)
from cofferline.operators.split import train_rows
from cofferline.session import materialise
from cofferline.sources.publish import publish, read_published


@dataclass
class Mined:
    """Itemsets and rules at the lowest thresholds, and their grids."""

    n_owners: int
    itemsets: DataFrame
    rules: DataFrame
    itemset_grid: DataFrame
    rule_grid: DataFrame


def mine(
    holdings: DataFrame,
    supports: list[float] = SUPPORT_GRID,
    confidences: list[float] = CONFIDENCE_GRID,
    split: DataFrame | None = None,
    owner: str = "owner",
    item: str = "item",
) -> Mined:
    """Mine (owner, item) rows; with ``split`` from ``owner_split``, the training owners only."""
    rows = holdings if split is None else train_rows(holdings, split, owner)
    itemsets, n_owners = frequent_itemsets_of_holdings(rows, min(supports), owner, item)
    itemsets = materialise(itemsets)
    rules = materialise(association_rules(itemsets, n_owners, min(confidences)))
    return Mined(
        n_owners,
        itemsets,
        rules,
        itemset_grid(itemsets, n_owners, supports),
        rule_grid(rules, supports, confidences),
    )


def publish_mined(mined: Mined, folder: str) -> None:
    """Write both grids below ``folder``, one partition folder per threshold or pair of thresholds.

    A repeated run replaces what was published before, as a whole."""
    publish(mined.itemset_grid, f"{folder}/itemsets", ["min_support"])
    publish(mined.rule_grid, f"{folder}/rules", ["min_support", "min_confidence"])


def published_grids(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The itemset grid and the rule grid last published in ``folder``."""
    rules = "antecedent array<string>, consequent array<string>, confidence double, lift double, support double"
    itemsets = read_published(spark, f"{folder}/itemsets", "items array<string>, freq long, min_support double")
    return itemsets, read_published(spark, f"{folder}/rules", f"{rules}, min_support double, min_confidence double")
