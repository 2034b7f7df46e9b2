"""Plain SQL that restates the registered queries over the same tables."""

from __future__ import annotations

from cofferline.registry.spark_queries import (
    BLEND_DEPTH,
    BRAND_CONFIDENCE,
    BRAND_CONFIDENCES,
    BRAND_SUPPORT,
    BRAND_SUPPORTS,
    DEPTH,
    K,
    RULE_CONFIDENCE,
    RULE_SUPPORT,
    SEED,
    TOP,
    TYPE_SUPPORT,
)
from cofferline.operators.rules import CONFIDENCE_GRID, SUPPORT_GRID

_HOLDINGS = """
holdings AS (
  SELECT CAST(o_custkey AS VARCHAR) AS owner, p_type AS chain, p_name AS token, p_brand AS brand,
         CASE WHEN l_returnflag <> 'N' THEN CAST(l_suppkey AS VARCHAR) END AS contract,
         CAST(l_suppkey AS VARCHAR) AS supplier, l_quantity AS amount, l_extendedprice AS value,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN c_name END AS name_tag,
         l_orderkey AS order_no, l_linenumber AS line_no, c_mktsegment AS segment
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
       JOIN customer ON o_custkey = c_custkey
)"""

_PORTFOLIO = (
    _HOLDINGS
    + """,
portfolio AS (SELECT owner, chain || '_' || brand AS item, amount, value FROM holdings)"""
)

_NAMES = (
    _HOLDINGS
    + """,
portfolio AS (SELECT owner, token AS item, amount, value FROM holdings)"""
)

_CONTRACTS = (
    _HOLDINGS
    + """,
portfolio AS (SELECT owner, chain || '_' || token || '_' || supplier AS item, amount, value FROM holdings)"""
)

_RATINGS = """,
rated AS (
  SELECT owner, item, amount * value AS asset,
         amount * value / nullif(sum(amount * value) OVER (PARTITION BY owner), 0) AS ratio
  FROM portfolio
),
means AS (SELECT owner, avg(ratio) AS mean_ratio FROM rated GROUP BY owner),
cells AS (
  SELECT owner, item, sum(ratio) AS ratio FROM rated GROUP BY owner, item HAVING sum(ratio) <> 0
),
centred AS (
  SELECT owner, item, ratio - mean_ratio AS centred FROM cells JOIN means USING (owner)
  WHERE abs(ratio - mean_ratio) >= 1e-12
)"""

_CLEAN = """,
nulled AS (SELECT * EXCLUDE (contract), nullif(contract, owner) AS contract FROM holdings),
keyed AS (SELECT *, concat_ws('_', chain, token, contract) AS item FROM nulled),
kept AS (
  SELECT * FROM keyed
  WHERE NOT (chain IS NOT DISTINCT FROM 'ECONOMY' AND token IS NOT DISTINCT FROM 'small ring'
             AND contract IS NULL)
)"""

_NAMED = (
    _HOLDINGS
    + """,
named AS (SELECT *, chain || '_' || token AS item FROM holdings)"""
)


def _itemsets(pairs: str, support: float) -> str:
    """All frequent itemsets, of any size: sets grow by one item, together with their owners."""
    return f"""
pairs AS ({pairs}),
total AS (SELECT count(DISTINCT owner) AS n FROM pairs),
singles AS (
  SELECT item, list(owner) AS owners FROM pairs GROUP BY item
  HAVING count(*) >= (SELECT n FROM total) * {support}::DOUBLE
),
itemsets AS MATERIALIZED (
  WITH RECURSIVE grown AS (
    SELECT [item] AS items, owners FROM singles
    UNION ALL
    SELECT list_append(items, item), common FROM (
      SELECT g.items, s.item, list_intersect(g.owners, s.owners) AS common
      FROM grown g JOIN singles s ON s.item > g.items[-1])
    WHERE len(common) >= (SELECT n FROM total) * {support}::DOUBLE
  )
  SELECT items, CAST(len(owners) AS BIGINT) AS freq FROM grown
)"""


def _rules(confidence: float) -> str:
    return f""",
splits AS (
  SELECT z.freq AS both_freq, x.freq AS x_freq, x.items AS antecedent,
         list_filter(z.items, lambda i: NOT list_contains(x.items, i)) AS consequent
  FROM itemsets z JOIN itemsets x ON len(x.items) < len(z.items) AND list_has_all(z.items, x.items)
),
rules AS (
  SELECT antecedent, consequent, both_freq / x_freq::DOUBLE AS confidence,
         (both_freq / x_freq::DOUBLE) / (y.freq / (SELECT n FROM total)::DOUBLE) AS lift,
         both_freq / (SELECT n FROM total)::DOUBLE AS support
  FROM splits JOIN itemsets y ON y.items = consequent
  WHERE both_freq / x_freq::DOUBLE > {confidence}::DOUBLE
)"""


_TYPE_PAIRS = (
    "SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS owner, p_type AS item "
    "FROM lineitem JOIN part ON l_partkey = p_partkey"
)
_BRAND_PAIRS = (
    "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS owner, p_brand AS item FROM lineitem "
    "JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"
)
_PORTFOLIO_PAIRS = "SELECT DISTINCT owner, item FROM portfolio"

_BRANDS = "WITH " + _itemsets(_BRAND_PAIRS, BRAND_SUPPORT)
_BRANDS_AND_RULES = _BRANDS + _rules(BRAND_CONFIDENCE)


def _values(numbers: list[float], name: str) -> str:
    rows = ", ".join(f"({n}::DOUBLE)" for n in numbers)
    return f"(VALUES {rows}) AS {name}_grid({name})"


def _sims(cells: str, row: str, key: str, value: str, name: str) -> str:
    return f""",
{name}_unit AS (
  SELECT {row} AS row, {key} AS key,
         {value} / sqrt(sum({value} * {value}) OVER (PARTITION BY {row})) AS w
  FROM {cells}
),
{name}_sims AS (
  SELECT a.row, b.row AS other, round(sum(a.w * b.w), 10) AS sim
  FROM {name}_unit a JOIN {name}_unit b ON a.key = b.key AND a.row <> b.row
  GROUP BY a.row, b.row HAVING round(sum(a.w * b.w), 10) <> 0
),
{name}_near AS (
  SELECT *, row_number() OVER (PARTITION BY row ORDER BY sim DESC, other) AS rank,
         count(*) OVER (PARTITION BY row) AS n_related
  FROM {name}_sims
),
{name}_best AS (SELECT * FROM {name}_near WHERE rank <= {K})"""


def _weights(name: str, rows: str, extend: bool) -> str:
    first = "1" if extend else "0"
    return f""",
{name}_limits AS (
  SELECT row, greatest({first}, {K} - least(greatest({rows} - 1 - max(n_related), 0),
         {K} - count(*) FILTER (WHERE sim > 0))) AS places
  FROM {name}_best GROUP BY row
),
{name}_kept AS (
  SELECT row, other, sim, sum(sim) OVER (PARTITION BY row) AS total
  FROM {name}_best JOIN {name}_limits USING (row) WHERE rank <= places
),
{name}_weights AS (
  SELECT row, other, sim / total AS weight FROM {name}_kept WHERE round(total, 10) <> 0
)"""


def _baseline(cells: str, row: str, col: str, value: str, name: str) -> str:
    return f""",
{name}_mu AS (SELECT avg(m) AS mu FROM (SELECT avg({value}) AS m FROM {cells} GROUP BY {col})),
{name}_rows AS (
  SELECT {row} AS row, avg({value}) - (SELECT mu FROM {name}_mu) AS row_bias FROM {cells} GROUP BY {row}
),
{name}_cols AS (
  SELECT {col} AS col, avg({value}) - (SELECT mu FROM {name}_mu) AS col_bias FROM {cells} GROUP BY {col}
)"""


_USER_NEAR = _sims("centred", "owner", "item", "centred", "u")
_ITEM_NEAR = _sims("cells", "item", "owner", "ratio", "i")
_USER_WEIGHTS = _USER_NEAR + _weights("u", "(SELECT count(*) FROM means)", True)
_ITEM_WEIGHTS = _ITEM_NEAR + _weights("i", "(SELECT count(DISTINCT item) FROM cells)", False)
_USER_BASE = _baseline("centred", "owner", "item", "centred", "u")
_ITEM_BASE = _baseline("cells", "item", "owner", "ratio", "i")

_USER_MODEL = (
    _USER_WEIGHTS
    + _USER_BASE
    + """,
u_offsets AS (
  SELECT r.row AS owner, r.row_bias + mean_ratio - pull AS shift
  FROM (SELECT w.row, sum(weight * row_bias) AS pull
        FROM u_weights w JOIN u_rows b ON b.row = w.other GROUP BY w.row) p
  JOIN u_rows r ON r.row = p.row JOIN means ON means.owner = r.row
),
u_terms AS (
  SELECT w.row AS owner, c.item, sum(weight * centred) AS term
  FROM u_weights w JOIN centred c ON c.owner = w.other GROUP BY w.row, c.item
)"""
)
def _user_top(depth: int) -> str:
    return _USER_MODEL + f""",
u_scores AS (
  SELECT o.owner, c.col AS item, round(shift + coalesce(term, 0), 10) AS score
  FROM u_offsets o CROSS JOIN u_cols c
  LEFT JOIN u_terms t ON t.owner = o.owner AND t.item = c.col
  WHERE NOT EXISTS (SELECT 1 FROM centred h WHERE h.owner = o.owner AND h.item = c.col)
),
user_top AS (
  SELECT owner, item, score, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY owner ORDER BY score DESC, item) AS rank FROM u_scores)
  WHERE rank <= {depth}
)"""


_ITEM_MODEL = (
    _ITEM_WEIGHTS
    + _ITEM_BASE
    + """,
i_pull AS (
  SELECT w.row, sum(weight * row_bias) AS pull
  FROM i_weights w JOIN i_rows b ON b.row = w.other GROUP BY w.row
),
i_bases AS (
  SELECT r.row AS item, pull IS NULL AS alone,
         round(CASE WHEN pull IS NULL THEN (SELECT mu FROM i_mu) + row_bias ELSE row_bias - pull END, 10) AS base
  FROM i_rows r LEFT JOIN i_pull p ON p.row = r.row
),
i_terms AS (
  SELECT c.owner, w.row AS item, sum(weight * ratio) AS term
  FROM i_weights w JOIN cells c ON c.item = w.other GROUP BY c.owner, w.row
)"""
)
def _item_top(depth: int) -> str:
    return _ITEM_MODEL + f""",
i_scores AS (
  SELECT o.col AS owner, b.item,
         round(CASE WHEN alone THEN col_bias ELSE 0 END + base + coalesce(term, 0), 10) AS score
  FROM i_cols o CROSS JOIN i_bases b
  LEFT JOIN i_terms t ON t.owner = o.col AND t.item = b.item
  WHERE NOT EXISTS (SELECT 1 FROM cells h WHERE h.owner = o.col AND h.item = b.item)
),
item_top AS (
  SELECT owner, item, score, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY owner ORDER BY score DESC, item) AS rank FROM i_scores)
  WHERE rank <= {depth}
)"""



def _matches(portfolio: str) -> str:
    return (
        ", "
        + _itemsets(portfolio, RULE_SUPPORT)
        + _rules(RULE_CONFIDENCE)
        + """,
own AS (SELECT owner, list(DISTINCT item) AS held FROM portfolio GROUP BY owner),
matches AS (
  SELECT owner, antecedent, consequent, confidence, lift,
         list_sort(list_filter(consequent, lambda i: NOT list_contains(held, i))) AS fresh
  FROM own JOIN rules ON list_has_all(held, antecedent)
  WHERE NOT list_has_all(held, consequent)
),
rule_score AS (
  SELECT owner, item, max(points) AS score
  FROM (SELECT owner, unnest(consequent) AS item, lift * confidence AS points FROM matches)
  GROUP BY owner, item
)"""
    )


_BLEND = """,
named_scores AS (
  SELECT owner, item, score * 2 AS part FROM rule_score
  UNION ALL SELECT owner, item, score * 1.5 FROM user_top
  UNION ALL SELECT owner, item, score * 1.75 FROM item_top
),
blended AS (
  SELECT owner, item, CAST(count(*) AS BIGINT) AS methods,
         round(sum(part) + 10 * (count(*) - 1), 10) AS score
  FROM named_scores GROUP BY owner, item
)"""

_DIVERSE = f""",
placed AS (
  SELECT *, row_number() OVER (PARTITION BY owner ORDER BY score DESC, item) AS place FROM blended
),
drawn AS (
  SELECT *, row_number() OVER (
    PARTITION BY owner, place <= {TOP * 8 // 10}
    ORDER BY md5(owner || '|' || item || '|{SEED}')) AS draw
  FROM placed
)
SELECT owner, CAST(CASE WHEN place <= {TOP * 8 // 10} THEN place ELSE draw + {TOP * 8 // 10} END AS INTEGER) AS rank,
       item, CASE WHEN place <= {TOP * 8 // 10} THEN 'top' ELSE 'tail' END AS pick,
       round(score, 6) AS score
FROM drawn WHERE place <= {TOP * 8 // 10} OR draw <= {TOP * 2 // 10}"""


def _split(owners: str) -> str:
    return f"""
owners AS ({owners}),
split AS (
  SELECT owner, CASE WHEN row_number() OVER (ORDER BY md5(owner || '|{SEED}'))
                          <= floor((SELECT count(*) FROM owners) * 0.2::DOUBLE)
                     THEN 'test' ELSE 'train' END AS split
  FROM owners
)"""


def _baseline_rows(name: str) -> str:
    return f"""
SELECT 'mu' AS kind, '' AS name, round(mu, 6) AS value FROM {name}_mu
UNION ALL SELECT 'row', row, round(row_bias, 6) FROM {name}_rows
UNION ALL SELECT 'col', col, round(col_bias, 6) FROM {name}_cols"""


_GROUPED_NUMBER = (
    "regexp_replace(CAST(CAST({} AS DECIMAL(12,2)) AS VARCHAR), '(\\d)(\\d{{3}}\\.)', '\\1,\\2')"
)
_MERGED = (
    _NAMED
    + """,
fresh AS (SELECT owner, item, amount, value + line_no AS value FROM named WHERE segment = 'BUILDING'),
portfolio AS (
  SELECT owner, item, amount, value FROM named WHERE owner NOT IN (SELECT owner FROM fresh)
  UNION ALL SELECT * FROM fresh
)"""
)
_NEW_USERS = (
    _HOLDINGS
    + """,
original AS (SELECT owner, token AS item, amount, value, segment FROM holdings),
portfolio AS (
  SELECT owner, item, amount, CASE WHEN segment = 'BUILDING' THEN value + amount ELSE value END AS value
  FROM original
)"""
)
_RANK = "CAST(rank AS INTEGER) AS rank"

ORACLE: dict[str, str] = {
    "clean_holdings": f"""WITH {_HOLDINGS}{_CLEAN}
SELECT owner, item, contract, amount, value, order_no, line_no FROM kept WHERE name_tag IS NULL""",
    "parse_money": f"""WITH texts AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CASE l_linenumber WHEN 5 THEN '-1' WHEN 4 THEN '0'
              ELSE {_GROUPED_NUMBER.format("l_quantity * 100")} END AS amount,
         CASE l_linenumber WHEN 7 THEN '$<0.000001' WHEN 6 THEN '<$0.000001' WHEN 3 THEN 'abc'
              ELSE '$' || {_GROUPED_NUMBER.format("l_extendedprice")} END AS value
  FROM lineitem
), numbers AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         try_cast(replace(amount, ',', '') AS DOUBLE) AS amount,
         CASE WHEN regexp_replace(value, '[$,]', '', 'g') = '<0.000001' THEN 0.000001::DOUBLE
              ELSE try_cast(regexp_replace(value, '[$,]', '', 'g') AS DOUBLE) END AS value
  FROM texts
)
SELECT *, amount > 0 AND value > 0 AS positive FROM numbers
WHERE amount IS NOT NULL AND value IS NOT NULL""",
    "user_portfolio": f"""WITH {_HOLDINGS}{_CLEAN}, positive AS (
  SELECT owner, item, order_no, line_no, amount, value, amount * value AS asset,
         sum(amount * value) OVER (PARTITION BY owner) AS total
  FROM kept WHERE amount > 0 AND value > 0
)
SELECT owner, item, order_no, line_no, amount, value, round(asset, 2) AS asset_value,
       round(total, 2) AS portfolio_value, round(asset / total * 100, 6) AS ratio FROM positive""",
    "total_amount": f"""WITH {_HOLDINGS}
SELECT owner, sum(amount) AS total_amount FROM holdings GROUP BY owner""",
    "basket_texts": f"""WITH {_NAMED}, firsts AS (
  SELECT owner, item, min(row(order_no, line_no)) AS first FROM named GROUP BY owner, item
)
SELECT owner, string_agg(item, '|' ORDER BY first, item) AS items FROM firsts GROUP BY owner""",
    "grouped_items": f"""WITH {_NAMED}
SELECT owner, string_agg(item, '|' ORDER BY order_no, line_no, item) AS items FROM named GROUP BY owner""",
    "duplicate_items": f"""WITH {_NAMED}, places AS (
  SELECT owner, item,
         row_number() OVER (PARTITION BY owner ORDER BY order_no, line_no, item) - 1 AS pos
  FROM named
)
SELECT owner, item, CAST(count(*) AS BIGINT) AS count,
       string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS positions
FROM places GROUP BY owner, item HAVING count(*) > 1""",
    "owner_counts": f"""WITH {_HOLDINGS}{_CLEAN}
SELECT 'raw' AS stage, CAST(count(DISTINCT owner) AS BIGINT) AS n_owners FROM holdings
UNION ALL SELECT 'cleaned', CAST(count(DISTINCT owner) AS BIGINT) FROM kept WHERE name_tag IS NULL""",
    "left_merge": f"""WITH {_NAMED}, account AS (
  SELECT CAST(o_custkey AS VARCHAR) AS owner, c_name AS name_tag, min(o_orderpriority) AS priority,
         round(c_acctbal, 2) AS balance
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
)
SELECT named.owner, item, order_no, line_no, account.name_tag, priority, balance
FROM named LEFT JOIN account ON named.owner = account.owner""",
    "frequent_types": f"""WITH {_itemsets(_TYPE_PAIRS, TYPE_SUPPORT)}
SELECT array_to_string(items, '|') AS items, freq,
       round(freq / (SELECT n FROM total)::DOUBLE, 6) AS support FROM itemsets""",
    "frequent_brands": f"{_BRANDS} SELECT array_to_string(items, '|') AS items, freq FROM itemsets",
    "levelwise_brands": f"{_BRANDS} SELECT array_to_string(items, '|') AS items, freq FROM itemsets",
    "two_pass_brands": f"{_BRANDS} SELECT array_to_string(items, '|') AS items, freq FROM itemsets",
    "itemset_grid_rows": f"""WITH {_itemsets(_TYPE_PAIRS, min(SUPPORT_GRID))}
SELECT min_support, array_to_string(items, '|') AS items, freq
FROM itemsets JOIN {_values(SUPPORT_GRID, "min_support")} ON freq >= min_support * (SELECT n FROM total)""",
    "rule_grid_rows": f"""{"WITH " + _itemsets(_TYPE_PAIRS, min(SUPPORT_GRID)) + _rules(min(CONFIDENCE_GRID))}
SELECT min_support, min_confidence, array_to_string(antecedent, '|') AS antecedent,
       array_to_string(consequent, '|') AS consequent, round(confidence, 6) AS confidence,
       round(lift, 6) AS lift, round(support, 6) AS support
FROM rules JOIN {_values(SUPPORT_GRID, "min_support")} ON support >= min_support
  JOIN {_values(CONFIDENCE_GRID, "min_confidence")} ON confidence >= min_confidence""",
    "itemset_ranking": f"""{_BRANDS}
SELECT row_number() OVER (ORDER BY freq DESC, array_to_string(items, '|')) AS pos,
       array_to_string(items, '|') AS items, freq FROM itemsets""",
    "brand_rules": f"""{_BRANDS_AND_RULES}
SELECT array_to_string(antecedent, '|') AS antecedent, array_to_string(consequent, '|') AS consequent,
       round(confidence, 6) AS confidence, round(lift, 6) AS lift, round(support, 6) AS support
FROM rules""",
    "itemset_grid": f"""{_BRANDS}
SELECT min_support, CAST(count(*) AS BIGINT) AS n_itemsets
FROM itemsets JOIN {_values(BRAND_SUPPORTS, "min_support")}
  ON freq >= min_support * (SELECT n FROM total) GROUP BY min_support""",
    "rule_grid": f"""{"WITH " + _itemsets(_BRAND_PAIRS, BRAND_SUPPORT) + _rules(min(BRAND_CONFIDENCES))}
SELECT min_support, min_confidence, CAST(count(*) AS BIGINT) AS n_rules
FROM rules JOIN {_values(BRAND_SUPPORTS, "min_support")} ON support >= min_support
  JOIN {_values(BRAND_CONFIDENCES, "min_confidence")} ON confidence >= min_confidence
GROUP BY min_support, min_confidence""",
    "train_itemsets": "WITH all_pairs AS (" + _BRAND_PAIRS + "),"
    + _split("SELECT DISTINCT owner FROM all_pairs")
    + ","
    + _itemsets(
        "SELECT owner, item FROM all_pairs JOIN split USING (owner) WHERE split = 'train'",
        BRAND_SUPPORT,
    )
    + """
SELECT array_to_string(items, '|') AS items, freq, CAST((SELECT n FROM total) AS INTEGER) AS n_train
FROM itemsets""",
    "list_texts": f"""WITH pairs AS ({_TYPE_PAIRS})
SELECT owner, '[' || string_agg('''' || item || '''', ', ' ORDER BY item) || ']' AS as_text,
       string_agg(item, '|' ORDER BY item) AS items FROM pairs GROUP BY owner""",
    "split_owners": f"""WITH {_PORTFOLIO},{_split("SELECT DISTINCT owner FROM portfolio")}
SELECT owner, split, CAST(count(*) AS BIGINT) AS n_rows
FROM portfolio JOIN split USING (owner) GROUP BY owner, split""",
    "investment_ratio": f"""WITH {_NAMED}, totals AS (
  SELECT owner, item, order_no, line_no, amount * value AS asset,
         sum(amount * value) OVER (PARTITION BY owner) AS total FROM named
)
SELECT owner, item, order_no, line_no, round(asset, 2) AS asset_value,
       round(total, 2) AS portfolio_value, round(asset / total, 6) AS ratio FROM totals""",
    "owner_mean": f"""WITH {_PORTFOLIO}{_RATINGS}
SELECT owner, round(mean_ratio, 6) AS mean_ratio FROM means""",
    "ratio_matrix": f"""WITH {_PORTFOLIO}{_RATINGS}
SELECT owner, item, round(ratio, 6) AS ratio FROM cells""",
    "centred_matrix": f"""WITH {_PORTFOLIO}{_RATINGS}
SELECT owner, item, round(centred, 6) AS centred FROM centred""",
    "wide_matrix": "",
    "merged_ratings": f"""WITH {_MERGED}{_RATINGS}
SELECT owner, item, round(ratio, 6) AS ratio FROM cells""",
    "baseline_user": f"WITH {_PORTFOLIO}{_RATINGS}{_USER_BASE}{_baseline_rows('u')}",
    "baseline_item": f"WITH {_PORTFOLIO}{_RATINGS}{_ITEM_BASE}{_baseline_rows('i')}",
    "user_neighbours": f"""WITH {_PORTFOLIO}{_RATINGS}{_USER_NEAR}
SELECT row, other, {_RANK}, round(sim, 6) AS sim FROM u_best""",
    "user_neighbours_sparse": f"""WITH {_CONTRACTS}{_RATINGS}{_USER_NEAR}
SELECT row, other, {_RANK}, round(sim, 6) AS sim FROM u_best""",
    "user_weights_sparse": f"""WITH {_CONTRACTS}{_RATINGS}{_USER_WEIGHTS}
SELECT row, other, round(weight, 6) AS weight FROM u_weights""",
    "item_neighbours": f"""WITH {_PORTFOLIO}{_RATINGS}{_ITEM_NEAR}
SELECT row, other, {_RANK}, round(sim, 6) AS sim FROM i_best""",
    "item_similarity": f"""WITH {_PORTFOLIO}{_RATINGS}{_ITEM_NEAR}
SELECT row, other, round(sim, 6) AS sim FROM i_sims""",
    "user_top": f"""WITH {_PORTFOLIO}{_RATINGS}{_user_top(DEPTH)}
SELECT owner, item, {_RANK}, round(score, 6) AS score FROM user_top""",
    "item_top": f"""WITH {_PORTFOLIO}{_RATINGS}{_item_top(DEPTH)}
SELECT owner, item, {_RANK}, round(score, 6) AS score FROM item_top""",
    "rule_matches": f"""WITH {_NAMES}{_matches(_PORTFOLIO_PAIRS)}
SELECT owner, array_to_string(antecedent, '|') AS antecedent,
       array_to_string(consequent, '|') AS consequent, round(confidence, 6) AS confidence,
       round(lift, 6) AS lift, array_to_string(fresh, '|') AS new_items FROM matches""",
    "suggested_items": f"""WITH {_NAMES}{_matches(_PORTFOLIO_PAIRS)}
SELECT DISTINCT owner, unnest(fresh) AS item FROM matches""",
    "rule_suggestions": f"""WITH {_NAMES}{_matches(_PORTFOLIO_PAIRS)}
SELECT DISTINCT owner, unnest(fresh) AS item FROM matches
WHERE owner IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')""",
    "rule_item_scores": f"""WITH {_NAMES}{_matches(_PORTFOLIO_PAIRS)}
SELECT owner, item, round(score, 6) AS score FROM rule_score""",
    "blended_scores": f"""WITH {_NAMES}{_RATINGS}{_user_top(BLEND_DEPTH)}{_item_top(BLEND_DEPTH)}{_matches(_PORTFOLIO_PAIRS)}{_BLEND}
SELECT owner, item, methods, round(score, 6) AS score FROM blended""",
    "diverse_list": f"""WITH {_NAMES}{_RATINGS}{_user_top(BLEND_DEPTH)}{_item_top(BLEND_DEPTH)}{_matches(_PORTFOLIO_PAIRS)}{_BLEND}{_DIVERSE}""",
    "recommend_new_users": "",
    "page_links": r"""WITH found AS (
  SELECT page_id, regexp_extract_all(html, '<a\s[^>]*?href="([^"]*)"', 1) AS links FROM pages
), opened AS (
  SELECT page_id, unnest(links) AS link, unnest(range(len(links))) AS pos FROM found
)
SELECT page_id, CAST(pos AS INTEGER) AS pos, link, trim(string_split(link, '/')[-1]) AS segment,
       split_part(trim(string_split(link, '/')[-1]), '?', 1) AS contract FROM opened""",
    "accounts_from_pages": """SELECT CAST(c_nationkey AS BIGINT) AS page_id,
       CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS INTEGER) AS row_no,
       CAST(c_nationkey AS VARCHAR) AS rank, CAST(c_custkey AS VARCHAR) AS owner,
       c_name || ' & Co' AS name_tag, c_mktsegment AS balance, '1%' AS percentage,
       CAST(length(c_name) AS VARCHAR) AS txn_count FROM customer""",
    "portfolios_from_pages": """SELECT l_orderkey AS page_id, CAST(l_orderkey AS VARCHAR) AS owner,
       p_type AS chain, p_name AS token,
       CASE WHEN l_returnflag <> 'N' THEN CAST(l_suppkey AS VARCHAR) END AS contract,
       '5%' AS portfolio_percent, '$' || CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS price,
       CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS amount,
       '$' || CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS value
FROM lineitem JOIN part ON l_partkey = p_partkey""",
}

# lines of one order may share a number; their page lists such rows by their markup
ORACLE["page_baskets"] = """WITH lines AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS owner, p_type AS chain, p_name AS token,
         CASE WHEN l_returnflag <> 'N' THEN nullif(CAST(l_suppkey AS VARCHAR), CAST(l_orderkey AS VARCHAR)) END AS contract,
         row(l_linenumber, '<tr><td> ' || p_type || ' </td><td> ' || CASE WHEN l_returnflag = 'N' THEN p_name
               ELSE '<a href="/token/' || l_suppkey || '?a=' || l_orderkey || '"><b>' || p_name || '</b></a>' END
             || ' </td><td> 5% </td><td> $' || CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR)
             || ' </td><td> ' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)) AS place
  FROM lineitem JOIN part ON l_partkey = p_partkey
  WHERE l_orderkey NOT IN (SELECT c_custkey FROM customer)
), firsts AS (
  SELECT owner, concat_ws('_', chain, token, contract) AS item, min(place) AS first FROM lines
  WHERE NOT (chain = 'ECONOMY' AND token = 'small ring' AND contract IS NULL) GROUP BY ALL
)
SELECT owner, string_agg(item, '|' ORDER BY first) AS items FROM firsts GROUP BY owner"""

# New users' values differ from the stored ones, so ratings use the changed portfolio while rules
# were mined on the items alone, which are the same in both.
ORACLE["recommend_new_users"] = (
    f"WITH {_NEW_USERS}{_RATINGS}{_user_top(BLEND_DEPTH)}{_item_top(BLEND_DEPTH)}{_matches(_PORTFOLIO_PAIRS)}{_BLEND}"
    + _DIVERSE.replace(
        "FROM drawn WHERE ",
        "FROM drawn WHERE owner IN (SELECT owner FROM original WHERE segment = 'BUILDING') AND (",
    )
    + ")"
)
ORACLE["recommend_raw_users"] = ORACLE["recommend_new_users"].replace(
    "THEN value + amount ELSE", "THEN CAST(CAST(value + amount AS DECIMAL(12,2)) AS DOUBLE) ELSE"
)
# The part types, which are the columns of the wide table.
_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
ORACLE["wide_matrix"] = (
    f"WITH {_HOLDINGS}, portfolio AS (SELECT owner, chain AS item, amount, value FROM holdings){_RATINGS} SELECT owner, "
    + ", ".join(
        f"round(coalesce(sum(ratio) FILTER (WHERE item = '{t}'), 0), 6) AS \"{t}\"" for t in _TYPES
    )
    + " FROM cells GROUP BY owner"
)
ORACLE["split_and_rmse"] = (
    f"""WITH {_HOLDINGS},
everything AS (SELECT owner, chain || '_' || brand AS item, amount, value FROM holdings),"""
    + _split("SELECT DISTINCT owner FROM everything")
    + f""",
draws AS (
  SELECT owner, item, amount, value, split = 'test' AND
         CAST(CAST('0x' || substr(md5(owner || '|' || item || '|{SEED}'), 1, 8) AS UBIGINT) AS DOUBLE)
           < 0.2::DOUBLE * 4294967296::DOUBLE AS hidden
  FROM everything JOIN split USING (owner)
),
portfolio AS (SELECT owner, item, amount, value FROM draws WHERE NOT hidden)"""
    + _RATINGS
    + _USER_MODEL
    + _ITEM_MODEL
    + """,
truth AS (
  SELECT owner, item, sum(amount * value) / max(total) AS ratio
  FROM (SELECT *, sum(amount * value) OVER (PARTITION BY owner) AS total FROM everything)
  GROUP BY owner, item
),
wanted AS (SELECT DISTINCT owner, item FROM draws WHERE hidden),
guesses AS (
  SELECT 'user' AS method, w.owner, w.item, shift + coalesce(term, 0) AS score
  FROM wanted w JOIN u_offsets o ON o.owner = w.owner JOIN u_cols c ON c.col = w.item
       LEFT JOIN u_terms t ON t.owner = w.owner AND t.item = w.item
  UNION ALL
  SELECT 'item', w.owner, w.item, CASE WHEN alone THEN col_bias ELSE 0 END + base + coalesce(term, 0)
  FROM wanted w JOIN i_bases b ON b.item = w.item JOIN i_cols o ON o.col = w.owner
       LEFT JOIN i_terms t ON t.owner = w.owner AND t.item = w.item
)
SELECT method, CAST(count(*) AS BIGINT) AS n, round(sqrt(avg(power(score - ratio, 2))), 6) AS rmse
FROM guesses JOIN truth USING (owner, item) GROUP BY method"""
)
