"""The given tables seen as holdings, portfolios, accounts and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cofferline.functions.text import item_key

NATIVE = {"native_chain": "ECONOMY", "native_token": "small ring"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def order_lines(spark: SparkSession, folder: str, customers: DataFrame | None = None) -> DataFrame:
    """Order lines with their order and part, and with the given columns of customers. Orders meet their
    customers before the lines, so lines are not moved once more."""
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    if customers is not None:
        orders = orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
    parts = table(spark, folder, "part").select("p_partkey", "p_type", "p_name", "p_brand")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).join(
        parts, lines["l_partkey"] == parts["p_partkey"]
    )


def holdings(spark: SparkSession, folder: str) -> DataFrame:
    """Raw holdings: customers own part names of a type, bought under a supplier's contract."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return order_lines(spark, folder, customers).select(
        F.col("o_custkey").cast("string").alias("owner"),
        F.col("p_type").alias("chain"),
        F.col("p_name").alias("token"),
        F.when(F.col("l_returnflag") != "N", F.col("l_suppkey").cast("string")).alias("contract"),
        F.col("l_quantity").alias("amount"),
        F.col("l_extendedprice").alias("value"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.col("c_name")).alias("name_tag"),
        F.col("l_orderkey").alias("order_no"),
        F.col("l_linenumber").alias("line_no"),
        F.col("c_mktsegment").alias("segment"),
    )


def named_items(spark: SparkSession, folder: str) -> DataFrame:
    """Holdings whose item is type and part name."""
    return holdings(spark, folder).withColumn("item", item_key(F.col("chain"), F.col("token")))


def contract_items(spark: SparkSession, folder: str) -> DataFrame:
    """Holdings whose item is type, part name and supplier: many items, few owners each."""
    lines = order_lines(spark, folder)
    return lines.select(
        F.col("o_custkey").cast("string").alias("owner"),
        item_key(F.col("p_type"), F.col("p_name"), F.col("l_suppkey").cast("string")).alias("item"),
        F.col("l_quantity").alias("amount"),
        F.col("l_extendedprice").alias("value"),
    )


def portfolio(spark: SparkSession, folder: str) -> DataFrame:
    """Holdings whose item is type and brand: few items, many owners each."""
    return order_lines(spark, folder).select(
        F.col("o_custkey").cast("string").alias("owner"),
        item_key(F.col("p_type"), F.col("p_brand")).alias("item"),
        F.col("l_quantity").alias("amount"),
        F.col("l_extendedprice").alias("value"),
    )


def name_items(spark: SparkSession, folder: str) -> DataFrame:
    """Holdings whose item is the part name: the baskets rules are mined from."""
    return order_lines(spark, folder).select(
        F.col("o_custkey").cast("string").alias("owner"),
        F.col("p_name").alias("item"),
        F.col("l_quantity").alias("amount"),
        F.col("l_extendedprice").alias("value"),
    )


def order_types(spark: SparkSession, folder: str) -> DataFrame:
    """Part types per order."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, folder, "part").select("p_partkey", "p_type")
    return lines.join(parts, lines["l_partkey"] == parts["p_partkey"]).select(
        F.col("l_orderkey").cast("string").alias("owner"), F.col("p_type").alias("item")
    )


def customer_brands(spark: SparkSession, folder: str) -> DataFrame:
    """Part brands per customer."""
    return order_lines(spark, folder).select(
        F.col("o_custkey").cast("string").alias("owner"), F.col("p_brand").alias("item")
    )


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Account rows of customers, one per order, so most are listed more than once."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderpriority")
    return orders.join(customers, orders["o_custkey"] == customers["c_custkey"]).select(
        F.col("o_custkey").cast("string").alias("owner"),
        F.col("c_name").alias("name_tag"),
        F.col("o_orderpriority").alias("priority"),
        F.round("c_acctbal", 2).alias("balance"),
    )


def money_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with amounts and values as the texts a web page would show."""

    def grouped(number):
        text = number.cast("decimal(12,2)").cast("string")
        return F.regexp_replace(text, r"(\d)(\d{3}\.)", "$1,$2")

    line = F.col("l_linenumber")
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(line == 5, F.lit("-1")).when(line == 4, F.lit("0"))
        .otherwise(grouped(F.col("l_quantity") * 100)).alias("amount"),
        F.when(line == 7, F.lit("$<0.000001")).when(line == 6, F.lit("<$0.000001"))
        .when(line == 3, F.lit("abc"))
        .otherwise(F.concat(F.lit("$"), grouped(F.col("l_extendedprice")))).alias("value"),
    )


def raw_user_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Portfolio rows of the customers of one segment as a web page would show them, all text. Their
    values differ from the stored ones; the contract is the owner's own address."""

    def grouped(number):
        return F.regexp_replace(number.cast("decimal(12,2)").cast("string"), r"(\d)(\d{3}\.)", "$1,$2")

    chosen = table(spark, folder, "customer").filter("c_mktsegment = 'BUILDING'").select("c_custkey")
    owner = F.col("o_custkey").cast("string")
    return order_lines(spark, folder, chosen).select(
        owner.alias("owner"),
        F.lit(None).cast("string").alias("chain"),
        F.col("p_name").alias("token"),
        owner.alias("contract"),
        grouped(F.col("l_quantity")).alias("amount"),
        F.concat(F.lit("$"), grouped(F.col("l_extendedprice") + F.col("l_quantity"))).alias("value"),
    )


def _cell(text):
    return F.concat(F.lit("<td> "), text, F.lit(" </td>"))


def account_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One HTML page of accounts per nation, with a header row and a link per account."""
    key = F.col("c_custkey").cast("string")
    link = F.concat(F.lit('<a href="/address/'), key, F.lit('">#'), key, F.lit("</a>"))
    row = F.concat(
        F.lit("<tr>"),
        _cell(F.col("c_nationkey").cast("string")),
        _cell(link),
        _cell(F.concat(F.col("c_name"), F.lit(" &amp; Co"))),
        _cell(F.col("c_mktsegment")),
        _cell(F.lit("1%")),
        _cell(F.length("c_name").cast("string")),
        F.lit("</tr>"),
    )
    rows = table(spark, folder, "customer").select("c_nationkey", "c_custkey", row.alias("row"))
    body = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "row"))), lambda s: s["row"]), ""
    )
    return rows.groupBy("c_nationkey").agg(body.alias("body")).select(
        F.col("c_nationkey").cast("long").alias("page_id"),
        F.concat(F.lit("https://example.org/accounts/"), F.col("c_nationkey")).alias("url"),
        F.concat(
            F.lit("<html><body><table><thead><tr><th>Rank</th></tr></thead><tbody>"),
            F.col("body"),
            F.lit("</tbody></table><table><tr><td>other</td></tr></table></body></html>"),
        ).alias("html"),
    )


def portfolio_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One HTML page per order with a table of its lines."""
    lines = table(spark, folder, "lineitem")
    parts = table(spark, folder, "part").select("p_partkey", "p_type", "p_name")
    link = F.when(
        F.col("l_returnflag") == "N", F.col("p_name")
    ).otherwise(
        F.concat(
            F.lit('<a href="/token/'), F.col("l_suppkey"), F.lit("?a="), F.col("l_orderkey"),
            F.lit('"><b>'), F.col("p_name"), F.lit("</b></a>"),
        )
    )
    price = F.col("l_extendedprice").cast("decimal(12,2)").cast("string")
    row = F.concat(
        F.lit("<tr>"), _cell(F.col("p_type")), _cell(link), _cell(F.lit("5%")),
        _cell(F.concat(F.lit("$"), price)), _cell(F.col("l_quantity").cast("int").cast("string")),
        _cell(F.concat(F.lit("$"), price)), F.lit("</tr>"),
    )
    rows = lines.join(parts, lines["l_partkey"] == parts["p_partkey"]).select(
        "l_orderkey", "l_linenumber", row.alias("row")
    )
    body = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "row"))), lambda s: s["row"]), ""
    )
    return rows.groupBy("l_orderkey").agg(body.alias("body")).select(
        F.col("l_orderkey").alias("page_id"),
        F.concat(F.lit("https://example.org/address/"), F.col("l_orderkey"), F.lit("#all")).alias("url"),
        F.concat(
            F.lit('<html><table id="menu"><tr><td>x</td></tr></table>'
                  '<table id="js-chain-table"><thead><tr><td>Chain</td></tr></thead><tbody>'),
            F.col("body"), F.lit("</tbody></table></html>"),
        ).alias("html"),
    )
