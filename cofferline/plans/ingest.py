"""From stored pages to baskets."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cofferline.operators.baskets import make_baskets
from cofferline.operators.clean import clean_holdings, left_merge, with_numbers
from cofferline.sources.pages import extract_accounts, extract_portfolios


def merged_pages(account_pages: DataFrame, portfolio_pages: DataFrame) -> DataFrame:
    """Portfolio rows of all portfolio pages with the account columns of their owners, all text."""
    accounts = extract_accounts(account_pages).drop("page_id", "row_no")
    return left_merge(extract_portfolios(portfolio_pages), accounts, dedupe_right=True)


def cleaned_pages(account_pages: DataFrame, portfolio_pages: DataFrame, **native: str) -> DataFrame:
    """Clean holdings with numbers: unlabelled owners, item keys, no native asset, no missing number."""
    return with_numbers(clean_holdings(merged_pages(account_pages, portfolio_pages), **native))


def baskets_of_pages(account_pages: DataFrame, portfolio_pages: DataFrame, **native: str) -> DataFrame:
    """(owner, items): distinct items of every unlabelled owner in the order of its pages."""
    return make_baskets(cleaned_pages(account_pages, portfolio_pages, **native), ["page_id", "row_no"])
