"""The registered queries: each runs one or more operators over whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cofferline.functions.text import list_from_text, text_from_list
from cofferline.operators import baskets as bk
from cofferline.operators import clean as cl
from cofferline.operators import ratings as rt
from cofferline.operators.baseline import Baseline, baseline
from cofferline.operators.blend import diverse_top
from cofferline.operators.itemsets import (
    frequent_itemsets,
    frequent_itemsets_of_holdings,
    levelwise_itemsets,
    two_pass_itemsets,
)
from cofferline.operators.match import best_rule_scores, matching_rules, new_items
from cofferline.operators.predict import item_predictions, user_predictions
from cofferline.operators.ranks import global_rank
from cofferline.operators.rules import CONFIDENCE_GRID, SUPPORT_GRID, association_rules
from cofferline.operators.similarity import cosine_pairs, neighbour_weights, top_neighbours
from cofferline.operators.split import owner_split, with_split
from cofferline.plans.evaluate import compare_methods
from cofferline.plans.ingest import baskets_of_pages
from cofferline.plans.mining import Mined, mine, publish_mined, published_grids
from cofferline.plans.recommend import (
    blended,
    item_neighbourhood,
    recommend,
    recommend_by_rules,
    recommend_raw,
    stored_ratings,
    user_neighbourhood,
)
from cofferline.registry import views
from cofferline.session import materialise, new_folder
from cofferline.sources.pages import extract_accounts, extract_portfolios, page_links

TYPE_SUPPORT = 0.05
BRAND_SUPPORT, BRAND_CONFIDENCE = 0.55, 0.5
BRAND_SUPPORTS, BRAND_CONFIDENCES = [0.55, 0.6, 0.65, 0.7], [0.7, 0.75, 0.8, 0.85]
RULE_SUPPORT, RULE_CONFIDENCE = 0.22, 0.48
K, DEPTH, BLEND_DEPTH, TOP, SEED = 5, 50, 50, 10, 7


def _text(column: str):
    return F.array_join(column, "|").alias(column)


def _round(column: str, digits: int = 6):
    return F.round(column, digits).alias(column)


# -- cleaning and baskets ---------------------------------------------------------------------


def clean_holdings(spark: SparkSession, folder: str) -> DataFrame:
    rows = cl.clean_holdings(views.holdings(spark, folder), **views.NATIVE)
    return rows.select("owner", "item", "contract", "amount", "value", "order_no", "line_no")


def parse_money(spark: SparkSession, folder: str) -> DataFrame:
    return cl.with_numbers(views.money_texts(spark, folder)).withColumn(
        "positive", (F.col("amount") > 0) & (F.col("value") > 0)
    )


def user_portfolio(spark: SparkSession, folder: str) -> DataFrame:
    texts = views.holdings(spark, folder).withColumn("amount", F.col("amount").cast("string"))
    texts = texts.withColumn(
        "value", F.concat(F.lit("$"), F.col("value").cast("decimal(12,2)").cast("string"))
    )
    rows = cl.clean_user_portfolio(texts, **views.NATIVE)
    return rows.select(
        "owner", "item", "order_no", "line_no", "amount", "value",
        _round("asset_value", 2), _round("portfolio_value", 2), _round("ratio"),
    )


def total_amount(spark: SparkSession, folder: str) -> DataFrame:
    return cl.total_amount(views.holdings(spark, folder))


def basket_texts(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.named_items(spark, folder)
    made = bk.make_baskets(rows, ["order_no", "line_no", "item"])
    return bk.items_as_text(made, separator="|")


def grouped_items(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.named_items(spark, folder)
    return bk.items_as_text(bk.group_items(rows, ["order_no", "line_no"]), separator="|")


def duplicate_items(spark: SparkSession, folder: str) -> DataFrame:
    return bk.duplicate_items(views.named_items(spark, folder), ["order_no", "line_no"])


def owner_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.holdings(spark, folder)
    cleaned = cl.clean_holdings(rows, **views.NATIVE)
    return bk.owner_count(rows).select(F.lit("raw").alias("stage"), "n_owners").unionByName(
        bk.owner_count(cleaned).select(F.lit("cleaned").alias("stage"), "n_owners")
    )


def left_merge(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.named_items(spark, folder).select("owner", "item", "order_no", "line_no")
    return cl.left_merge(rows, views.accounts(spark, folder), dedupe_right=True)


# -- mining -----------------------------------------------------------------------------------


def frequent_types(spark: SparkSession, folder: str) -> DataFrame:
    found, n = frequent_itemsets_of_holdings(views.order_types(spark, folder), TYPE_SUPPORT)
    return found.select(_text("items"), "freq", F.round(F.col("freq") / n, 6).alias("support"))


def frequent_brands(spark: SparkSession, folder: str) -> DataFrame:
    made = bk.make_baskets(views.customer_brands(spark, folder))
    return frequent_itemsets(made, BRAND_SUPPORT).select(_text("items"), "freq")


def levelwise_brands(spark: SparkSession, folder: str) -> DataFrame:
    made = materialise(bk.make_baskets(views.customer_brands(spark, folder)))
    return levelwise_itemsets(made, BRAND_SUPPORT).select(_text("items"), "freq")


def two_pass_brands(spark: SparkSession, folder: str) -> DataFrame:
    made = bk.make_baskets(views.customer_brands(spark, folder))
    return two_pass_itemsets(made, BRAND_SUPPORT).select(_text("items"), "freq")


def itemset_ranking(spark: SparkSession, folder: str) -> DataFrame:
    found, _ = frequent_itemsets_of_holdings(views.customer_brands(spark, folder), BRAND_SUPPORT)
    ranked = global_rank(found, F.col("freq").desc(), F.array_join("items", "|"))
    return ranked.select("pos", _text("items"), "freq")


def brand_rules(spark: SparkSession, folder: str) -> DataFrame:
    found, n = frequent_itemsets_of_holdings(views.customer_brands(spark, folder), BRAND_SUPPORT)
    rules = association_rules(materialise(found), n, BRAND_CONFIDENCE)
    return rules.select(
        _text("antecedent"), _text("consequent"), _round("confidence"), _round("lift"), _round("support")
    )


def itemset_grid(spark: SparkSession, folder: str) -> DataFrame:
    mined = mine(views.customer_brands(spark, folder), BRAND_SUPPORTS, BRAND_CONFIDENCES)
    return mined.itemset_grid.groupBy("min_support").agg(F.count("*").alias("n_itemsets"))


def rule_grid(spark: SparkSession, folder: str) -> DataFrame:
    mined = mine(views.customer_brands(spark, folder), BRAND_SUPPORTS, BRAND_CONFIDENCES)
    return mined.rule_grid.groupBy("min_support", "min_confidence").agg(
        F.count("*").alias("n_rules")
    )


def _published(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Both grids at all thresholds, mined from part types per order, published and read back."""
    mined: Mined = mine(views.order_types(spark, folder), SUPPORT_GRID, CONFIDENCE_GRID)
    place = new_folder(spark)
    publish_mined(mined, place)
    return published_grids(spark, place)


def itemset_grid_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _published(spark, folder)[0].select("min_support", _text("items"), "freq")


def rule_grid_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _published(spark, folder)[1].select(
        "min_support", "min_confidence", _text("antecedent"), _text("consequent"),
        _round("confidence"), _round("lift"), _round("support"),
    )


def train_itemsets(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.customer_brands(spark, folder)
    mined = mine(rows, BRAND_SUPPORTS, BRAND_CONFIDENCES, owner_split(rows, 0.2, SEED))
    return mined.itemsets.select(_text("items"), "freq", F.lit(mined.n_owners).alias("n_train"))


def list_texts(spark: SparkSession, folder: str) -> DataFrame:
    rows = bk.make_baskets(views.order_types(spark, folder)).withColumn(
        "as_text", text_from_list(F.col("items"))
    )
    return rows.select("owner", "as_text", F.array_join(list_from_text(F.col("as_text")), "|").alias("items"))


def split_owners(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.portfolio(spark, folder)
    return with_split(rows, 0.2, SEED).groupBy("owner", "split").agg(F.count("*").alias("n_rows"))


# -- ratings ----------------------------------------------------------------------------------


def investment_ratio(spark: SparkSession, folder: str) -> DataFrame:
    rows = rt.investment_ratio(views.named_items(spark, folder))
    return rows.select(
        "owner", "item", "order_no", "line_no",
        _round("asset_value", 2), _round("portfolio_value", 2), _round("ratio"),
    )


def owner_mean(spark: SparkSession, folder: str) -> DataFrame:
    rows = rt.investment_ratio(views.portfolio(spark, folder))
    return rt.owner_mean(rows).select("owner", _round("mean_ratio"))


def ratio_matrix(spark: SparkSession, folder: str) -> DataFrame:
    rows = rt.investment_ratio(views.portfolio(spark, folder))
    return rt.ratio_matrix(rows).select("owner", "item", _round("ratio"))


def centred_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return rt.build_ratings(views.portfolio(spark, folder)).centred.select(
        "owner", "item", _round("centred")
    )


def wide_matrix(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.holdings(spark, folder).withColumn("item", F.col("chain"))
    items = sorted(row[0] for row in views.table(spark, folder, "part").select("p_type").distinct().collect())
    wide = rt.wide_matrix(rt.build_ratings(rows).cells, items)
    return wide.select("owner", *[_round(item) for item in items])


def merged_ratings(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.named_items(spark, folder)
    user = rows.filter(F.col("segment") == "BUILDING").withColumn("value", F.col("value") + F.col("line_no"))
    user = user.select("owner", "item", "amount", "value")
    return rt.build_ratings(rows, user).cells.select("owner", "item", _round("ratio"))


def _baseline_rows(base: Baseline) -> DataFrame:
    return (
        base.mu.select(F.lit("mu").alias("kind"), F.lit("").alias("name"), _round_as("mu"))
        .unionByName(base.rows.select(F.lit("row").alias("kind"), F.col("row").alias("name"), _round_as("row_bias")))
        .unionByName(base.cols.select(F.lit("col").alias("kind"), F.col("col").alias("name"), _round_as("col_bias")))
    )


def _round_as(column: str):
    return F.round(column, 6).alias("value")


def baseline_user(spark: SparkSession, folder: str) -> DataFrame:
    centred = rt.build_ratings(views.portfolio(spark, folder)).centred
    return _baseline_rows(baseline(centred, "owner", "item", "centred", store=True))


def baseline_item(spark: SparkSession, folder: str) -> DataFrame:
    cells = rt.build_ratings(views.portfolio(spark, folder)).cells
    return _baseline_rows(baseline(cells, "item", "owner", "ratio", store=True))


# -- similarity -------------------------------------------------------------------------------


def _neighbours(near: DataFrame) -> DataFrame:
    return near.select("row", "other", "rank", _round("sim"))


def user_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    ratings = stored_ratings(views.portfolio(spark, folder))
    return _neighbours(top_neighbours(ratings.centred, K, "owner", "item", "centred"))


def user_neighbours_sparse(spark: SparkSession, folder: str) -> DataFrame:
    ratings = stored_ratings(views.contract_items(spark, folder))
    return _neighbours(top_neighbours(ratings.centred, K, "owner", "item", "centred"))


def user_weights_sparse(spark: SparkSession, folder: str) -> DataFrame:
    ratings = stored_ratings(views.contract_items(spark, folder))
    near = top_neighbours(ratings.centred, K, "owner", "item", "centred")
    weights = neighbour_weights(near, K, ratings.means.count(), extend=True)
    return weights.select("row", "other", _round("weight"))


def item_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    ratings = stored_ratings(views.portfolio(spark, folder))
    return _neighbours(top_neighbours(ratings.cells, K, "item", "owner", "ratio"))


def item_similarity(spark: SparkSession, folder: str) -> DataFrame:
    ratings = stored_ratings(views.portfolio(spark, folder))
    return cosine_pairs(ratings.cells, "item", "owner", "ratio").select("row", "other", _round("sim"))


# -- predictions and recommendations ----------------------------------------------------------


def _scores(df: DataFrame) -> DataFrame:
    return df.select("owner", "item", "rank", _round("score"))


def user_top(spark: SparkSession, folder: str) -> DataFrame:
    ratings = stored_ratings(views.portfolio(spark, folder))
    near = user_neighbourhood(ratings, K)
    return _scores(user_predictions(ratings, near.weights, near.base, DEPTH))


def item_top(spark: SparkSession, folder: str) -> DataFrame:
    ratings = stored_ratings(views.portfolio(spark, folder))
    near = item_neighbourhood(ratings, K)
    return _scores(item_predictions(ratings, near.weights, near.base, DEPTH))


def _rules(rows: DataFrame, support: float = RULE_SUPPORT) -> DataFrame:
    found, n = frequent_itemsets_of_holdings(rows, support)
    return materialise(association_rules(materialise(found), n, RULE_CONFIDENCE))


def _held_names(spark: SparkSession, folder: str) -> DataFrame:
    """(owner, item), written once for mining and matching."""
    return materialise(views.name_items(spark, folder).select("owner", "item").distinct())


def rule_matches(spark: SparkSession, folder: str) -> DataFrame:
    rows = _held_names(spark, folder)
    return matching_rules(rows, _rules(rows)).select(
        "owner", _text("antecedent"), _text("consequent"),
        _round("confidence"), _round("lift"), _text("new_items"),
    )


def suggested_items(spark: SparkSession, folder: str) -> DataFrame:
    rows = _held_names(spark, folder)
    return new_items(matching_rules(rows, _rules(rows)))


def rule_item_scores(spark: SparkSession, folder: str) -> DataFrame:
    rows = _held_names(spark, folder)
    return best_rule_scores(rows, _rules(rows)).select("owner", "item", _round("score"))


def _blended(spark: SparkSession, folder: str, support: float = RULE_SUPPORT) -> DataFrame:
    # one reading of the sources: cells of owner and item serve mining, matching and ratings
    rated = materialise(rt.rated_cells(views.name_items(spark, folder)))
    held = rated.select("owner", "item")
    return blended(held, _rules(held, support), rt.as_ratings(rated), k=K, depth=BLEND_DEPTH)


def blended_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _blended(spark, folder).select("owner", "item", "methods", _round("score"))


def diverse_list(spark: SparkSession, folder: str, support: float = RULE_SUPPORT) -> DataFrame:
    return diverse_top(_blended(spark, folder, support), TOP, SEED).select(
        "owner", "rank", "item", "pick", _round("score")
    )


def recommend_new_users(spark: SparkSession, folder: str) -> DataFrame:
    rows = materialise(views.name_items(spark, folder))  # for rules, new users and ratings
    segments = views.table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("owner"), "c_mktsegment"
    )
    new = rows.join(segments.filter(F.col("c_mktsegment") == "BUILDING"), "owner", "left_semi")
    user = new.withColumn("value", F.col("value") + F.col("amount"))
    return recommend(rows, _rules(rows), user=user, k=K, n=TOP, depth=BLEND_DEPTH, seed=SEED).select(
        "owner", "rank", "item", "pick", _round("score")
    )


def recommend_raw_users(spark: SparkSession, folder: str) -> DataFrame:
    rated = materialise(rt.rated_cells(views.name_items(spark, folder)))
    rules, raw = _rules(rated.select("owner", "item")), views.raw_user_rows(spark, folder)
    return recommend_raw(rated, rules, raw, K, TOP, BLEND_DEPTH, SEED).select(
        "owner", "rank", "item", "pick", _round("score")
    )


def rule_suggestions(spark: SparkSession, folder: str) -> DataFrame:
    """From raw rows and a rule table whose sides are list texts, as files hold them."""
    texts = _rules(views.name_items(spark, folder))
    for side in ("antecedent", "consequent"):
        texts = texts.withColumn(side, text_from_list(F.col(side)))
    for side in ("antecedent", "consequent"):
        texts = texts.withColumn(side, list_from_text(F.col(side)))
    return recommend_by_rules(views.raw_user_rows(spark, folder), texts)


def split_and_rmse(spark: SparkSession, folder: str) -> DataFrame:
    found = compare_methods(views.portfolio(spark, folder), K, 0.2, 0.2, SEED)
    return found.select("method", "n", _round("rmse"))


# -- pages ------------------------------------------------------------------------------------


def links(spark: SparkSession, folder: str) -> DataFrame:
    return page_links(views.table(spark, folder, "pages"))


def accounts_from_pages(spark: SparkSession, folder: str) -> DataFrame:
    return extract_accounts(views.account_pages(spark, folder))


def portfolios_from_pages(spark: SparkSession, folder: str) -> DataFrame:
    return extract_portfolios(views.portfolio_pages(spark, folder)).drop("row_no")


def page_baskets(spark: SparkSession, folder: str) -> DataFrame:
    pages = views.account_pages(spark, folder), views.portfolio_pages(spark, folder)
    return bk.items_as_text(baskets_of_pages(*pages, **views.NATIVE), separator="|")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_holdings": clean_holdings,
    "parse_money": parse_money,
    "user_portfolio": user_portfolio,
    "total_amount": total_amount,
    "basket_texts": basket_texts,
    "grouped_items": grouped_items,
    "duplicate_items": duplicate_items,
    "owner_counts": owner_counts,
    "left_merge": left_merge,
    "frequent_types": frequent_types,
    "frequent_brands": frequent_brands,
    "levelwise_brands": levelwise_brands,
    "two_pass_brands": two_pass_brands,
    "itemset_ranking": itemset_ranking,
    "brand_rules": brand_rules,
    "itemset_grid": itemset_grid,
    "rule_grid": rule_grid,
    "itemset_grid_rows": itemset_grid_rows,
    "rule_grid_rows": rule_grid_rows,
    "train_itemsets": train_itemsets,
    "list_texts": list_texts,
    "split_owners": split_owners,
    "investment_ratio": investment_ratio,
    "owner_mean": owner_mean,
    "ratio_matrix": ratio_matrix,
    "centred_matrix": centred_matrix,
    "wide_matrix": wide_matrix,
    "merged_ratings": merged_ratings,
    "baseline_user": baseline_user,
    "baseline_item": baseline_item,
    "user_neighbours": user_neighbours,
    "user_neighbours_sparse": user_neighbours_sparse,
    "user_weights_sparse": user_weights_sparse,
    "item_neighbours": item_neighbours,
    "item_similarity": item_similarity,
    "user_top": user_top,
    "item_top": item_top,
    "rule_matches": rule_matches,
    "suggested_items": suggested_items,
    "rule_item_scores": rule_item_scores,
    "blended_scores": blended_scores,
    "diverse_list": diverse_list,
    "recommend_new_users": recommend_new_users,
    "recommend_raw_users": recommend_raw_users,
    "rule_suggestions": rule_suggestions,
    "split_and_rmse": split_and_rmse,
    "page_links": links,
    "accounts_from_pages": accounts_from_pages,
    "portfolios_from_pages": portfolios_from_pages,
    "page_baskets": page_baskets,
}
