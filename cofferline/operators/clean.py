"""Cleaning of raw holdings. All steps but the merge and the totals are narrow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cofferline.functions import text as tx

# The native asset that every owner may hold and that says nothing about taste.
NATIVE_CHAIN = "ETH"
NATIVE_TOKEN = "Ether (ETH)"


def keep_unlabelled(df: DataFrame, name_tag: str = "name_tag") -> DataFrame:
    """Rows of owners without a public name."""
    return df.filter(F.col(name_tag).isNull())


def null_self_contract(df: DataFrame, owner: str = "owner", contract: str = "contract") -> DataFrame:
    """Null the contract where it is the owner itself."""
    return df.withColumn(contract, F.nullif(F.col(contract), F.col(owner)))


def with_item(
    df: DataFrame, chain: str = "chain", token: str = "token", contract: str = "contract", item: str = "item"
) -> DataFrame:
    """Add the item key."""
    return df.withColumn(item, tx.item_key(F.col(chain), F.col(token), F.col(contract)))


def drop_native_asset(
    df: DataFrame,
    chain: str = "chain",
    token: str = "token",
    contract: str = "contract",
    native_chain: str = NATIVE_CHAIN,
    native_token: str = NATIVE_TOKEN,
    strict_null: bool = False,
) -> DataFrame:
    """Drop the native asset. ``strict_null`` also drops rows where the test is unknown."""
    if strict_null:
        same = (F.col(chain) == native_chain) & (F.col(token) == native_token)
    else:
        same = F.col(chain).eqNullSafe(native_chain) & F.col(token).eqNullSafe(native_token)
    return df.filter(~(same & F.col(contract).isNull()))


def clean_holdings(df: DataFrame, strict_null: bool = False, **native: str) -> DataFrame:
    """Unlabelled owners, self contracts nulled, item key added, native asset dropped."""
    step = with_item(null_self_contract(keep_unlabelled(df)))
    return drop_native_asset(step, strict_null=strict_null, **native)


def with_numbers(
    df: DataFrame,
    amount: str = "amount",
    value: str = "value",
    tiny_value: float | None = tx.TINY_NUMBER,
    strict_amount: bool = False,
    positive_only: bool = False,
) -> DataFrame:
    """Turn the money texts into doubles and drop rows where one of them is missing."""
    out = df.withColumn(amount, tx.amount_number(F.col(amount), strict_amount)).withColumn(
        value, tx.value_number(F.col(value), tiny_value)
    )
    out = out.dropna(subset=[amount, value])
    if positive_only:
        out = out.filter((F.col(amount) > 0) & (F.col(value) > 0))
    return out


def asset_value(amount: str = "amount", value: str = "value", price: str | None = None) -> Column:
    """Amount times value, or amount times ``price`` when that column is named."""
    return F.col(amount) * F.col(price or value)


def total_amount(df: DataFrame, owner: str = "owner", amount: str = "amount") -> DataFrame:
    """Summed amount per owner."""
    return df.groupBy(owner).agg(F.sum(amount).alias("total_amount"))


def left_merge(
    portfolios: DataFrame, accounts: DataFrame, on: str = "owner", dedupe_right: bool = False
) -> DataFrame:
    """All portfolio rows with their account columns.

    An account listed twice doubles the rows; ``dedupe_right`` keeps one row per account, the
    smallest by its other columns, so that a rerun picks the same one.
    """
    if dedupe_right:
        rest = [c for c in accounts.columns if c != on]
        accounts = (
            accounts.groupBy(on).agg(F.min(F.struct(*rest)).alias("account")).select(on, "account.*")
        )
    return portfolios.join(accounts, on=on, how="left")


def clean_user_portfolio(df: DataFrame, **native: str) -> DataFrame:
    """Raw rows of given users to clean holdings with the ratio in percent of each portfolio."""
    from cofferline.operators.ratings import investment_ratio

    rows = drop_native_asset(with_item(null_self_contract(df)), **native)
    rows = with_numbers(rows, tiny_value=None, positive_only=True)
    return investment_ratio(rows, scale=100.0)
