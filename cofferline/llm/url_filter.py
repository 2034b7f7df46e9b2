"""Filters for URLs with an index of rules by their rarest literal token, in DataFrame operations only.

A rule is a regular expression plus the literal tokens that every URL it fits must contain. Tokens
are counted over all URLs, each rule is filed under the rarest of its own, a URL's tokens fetch the
rules filed under them, and only these are run as regular expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cofferline.llm.common import ASCII_LOWER, ASCII_UPPER

_BETWEEN_TOKENS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"

#: Words whose whole appearance in a host name marks it as unwanted.
UNWANTED_HOST_WORDS = ["spam", "pills", "casino", "viagra", "porn", "malware", "phishing", "warez"]

RULES = "rule string, verdict string, pattern string, weight int, tokens array<string>"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, _PARTS, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def site_rule(verdict: str, rule: str) -> tuple:
    """A rule like ``example.net/en/``: that host and its subdomains, paths that start so."""
    host, _, rest = rule.partition("/")
    path = "/" + rest
    pattern = rf"(?s)^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}"
    # a token that the path breaks off may go on in the URL, so it is no whole token
    whole = path if not path[-1].isalnum() else path[: len(path.rstrip("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"))]
    tokens = [t for t in re.split(_BETWEEN_TOKENS, f"{host}{whole}".lower()) if t]
    return rule, verdict, pattern, len(host) + len(path), tokens


def host_word_rule(verdict: str, word: str) -> tuple:
    """A nameless rule of the method: hosts that hold the word between dots or hyphens."""
    return None, verdict, rf"^(?:[^/]*[.-])?{re.escape(word)}(?:[.-][^/]*)?(?:/|$)", 0, [word]


def rule_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, RULES)


def rules_by_rarest_token(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """``rules`` with ``token``, the one of each rule's tokens that the fewest URLs hold. Rules with a
    token that no URL holds are left out: they fit nothing. Rules without tokens are filed under the
    empty token, which every URL has."""
    filed = rules.withColumn("tokens", F.when(F.size("tokens") > 0, F.col("tokens")).otherwise(F.array(F.lit(""))))
    wanted = filed.select(F.explode("tokens").alias("token")).distinct()
    held = urls.select(F.explode("tokens").alias("token")).join(wanted, "token")
    counts = held.groupBy("token").agg(F.count("*").alias("n"))
    counted = filed.withColumn("token", F.explode("tokens")).join(counts, "token", "left")
    rarest = counted.groupBy("rule", "verdict", "pattern", "weight").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("best")
    )
    return rarest.filter("best.n > 0").select("rule", "verdict", "pattern", "weight", F.col("best.token").alias("token"))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", otherwise: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row of ``pages``.

    Of the rules that fit a URL the one of largest weight wins, ties by verdict, then rule text. A URL
    that no rule fits gets a null rule and the verdict ``otherwise``; so do null URLs and URLs without
    ``://``, whose host and path are empty. Rows stay as many as they were, repeated ones too; columns
    of those four names are replaced. Only distinct host and path pairs are matched, so a URL that a
    third of all rows share is judged once.
    """
    named = pages.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    named = named.drop("rule", "verdict")
    site = F.concat("host", "path")
    # the trailing empty token stands for rules that have no literal token
    tokens = F.array_distinct(F.concat(F.split(F.lower(site), _BETWEEN_TOKENS), F.array(F.lit(""))))
    urls = named.select("host", "path").distinct().withColumn("tokens", tokens)
    index = rules_by_rarest_token(rules, urls)
    candidates = urls.select("host", "path", F.explode("tokens").alias("token")).join(index, "token")
    fits = candidates.filter(F.rlike(F.concat("host", "path"), F.col("pattern")))
    best = (
        fits.groupBy("host", "path")
        .agg(F.max(F.struct("weight", "verdict", "rule")).alias("best"))
        .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    )
    judged = named.join(best, ["host", "path"], "left")
    return judged.select(
        *[c for c in named.columns], "rule", F.coalesce("verdict", F.lit(otherwise)).alias("verdict")
    )
