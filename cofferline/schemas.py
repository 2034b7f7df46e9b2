"""Explicit schemas of the tables at the edge of the library, and their raw header names."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType


def _strings(*names: str) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


# Header names of the raw files, in file order, with the column names used here.
ACCOUNT_HEADERS = {
    "Rank": "rank",
    "Address": "owner",
    "Name Tag": "name_tag",
    "Balance": "balance",
    "Percentage": "percentage",
    "Txn Count": "txn_count",
}
PORTFOLIO_HEADERS = {
    "Address": "owner",
    "Chain": "chain",
    "Token": "token",
    "Contract Address": "contract",
    "Portfolio %": "portfolio_percent",
    "Price": "price",
    "Amount": "amount",
    "Value": "value",
}
MERGED_HEADERS = PORTFOLIO_HEADERS | {k: v for k, v in ACCOUNT_HEADERS.items() if k != "Address"}
CLEANED_HEADERS = MERGED_HEADERS | {"Item": "item"}

ACCOUNTS = _strings(*ACCOUNT_HEADERS.values())
PORTFOLIOS = _strings(*PORTFOLIO_HEADERS.values())

BASKETS = StructType(
    [StructField("owner", StringType()), StructField("items", ArrayType(StringType()))]
)
ITEMSETS = StructType(
    [StructField("items", ArrayType(StringType())), StructField("freq", LongType())]
)
RULES = StructType(
    [
        StructField("antecedent", ArrayType(StringType())),
        StructField("consequent", ArrayType(StringType())),
        StructField("confidence", DoubleType()),
        StructField("lift", DoubleType()),
        StructField("support", DoubleType()),
    ]
)
