"""Cleaning, baskets, mining, rules, matching, blending, files and pages."""

import itertools
import os
import random

import pyarrow as pa
import pytest

from cofferline.functions.text import links_in_html, list_from_text
from pyspark.sql import Observation, Row
from pyspark.sql import functions as F

from cofferline.functions import text as tx
from cofferline.operators import baskets as bk
from cofferline.operators.baseline import _means as baseline_means
from cofferline.operators.baseline import baseline
from cofferline.operators import clean as cl
from cofferline.operators.blend import blend_scores, diverse_top, rule_scores
from cofferline.operators.itemsets import (
    count_itemsets,
    frequent_itemsets,
    frequent_itemsets_of_holdings,
    levelwise_itemsets,
    two_pass_itemsets,
)
from cofferline.operators.match import best_rule_scores, matching_rules, new_items
from cofferline.operators.ranks import global_rank, ordered_positions
from cofferline.operators.ratings import merge_user, rated_cells, replaced_owners
from cofferline.operators.rules import association_rules, by_confidence, by_frequency, itemset_grid, rule_grid
from cofferline.operators.settree import SetTree, by_first_item
from cofferline.operators.split import held_out_rows, owner_split, train_rows
from cofferline.plans.evaluate import rmse
from cofferline.plans.ingest import baskets_of_pages
from cofferline.plans.mining import Mined, mine, publish_mined, published_grids
from cofferline.plans.recommend import recommend, recommend_by_rules, recommend_raw
from cofferline.session import drop_stored, materialise
from cofferline.sources import files, pages
from cofferline.sources.publish import drop_old_attempts, manifest
from golden_tables import BASKETS, ITEMSETS, RULES

# Itemsets, then rules at confidence 0.5, 0.6, 0.7, 0.8, per support threshold.
GRID = {
    0.05: (46, 154, 124, 83, 54), 0.06: (41, 151, 121, 80, 52), 0.07: (35, 150, 121, 80, 52),
    0.08: (34, 148, 120, 79, 51), 0.09: (33, 148, 120, 79, 51), 0.10: (33, 148, 120, 79, 51),
    0.11: (33, 148, 120, 79, 51), 0.12: (33, 148, 120, 79, 51), 0.13: (33, 148, 120, 79, 51),
    0.14: (30, 114, 94, 63, 41), 0.15: (26, 85, 73, 50, 33), 0.16: (24, 80, 69, 49, 32),
    0.17: (24, 80, 69, 49, 32), 0.18: (22, 69, 59, 43, 29), 0.19: (21, 65, 55, 41, 28),
    0.20: (16, 33, 29, 22, 14),
}


@pytest.fixture(scope="module")
def golden(spark):
    return spark.createDataFrame([(sorted(items), freq) for items, freq in ITEMSETS], "items array<string>, freq bigint")


def test_golden_rules(golden):
    rules = association_rules(golden, BASKETS, 0.7)
    found = {(tuple(r[0]), tuple(r[1])): (r[2], r[3], r[4]) for r in rules.collect()}
    assert found == {(tuple(sorted(left)), tuple(sorted(right))): tuple(numbers) for left, right, *numbers in RULES}
    assert [r["confidence"] for r in by_confidence(rules).collect()] == [row[2] for row in RULES]
    assert [r["freq"] for r in by_frequency(golden).collect()] == [freq for _, freq in ITEMSETS]


def test_golden_grid(golden):
    sets = itemset_grid(golden, BASKETS).groupBy("min_support").count().collect()
    rules = rule_grid(association_rules(golden, BASKETS, 0.5))
    cells = rules.groupBy("min_support", "min_confidence").count().collect()
    assert {r["min_support"]: r["count"] for r in sets} == {s: v[0] for s, v in GRID.items()}
    assert {(r["min_support"], r["min_confidence"]): r["count"] for r in cells} == {
        (s, c): v[i + 1] for s, v in GRID.items() for i, c in enumerate((0.5, 0.6, 0.7, 0.8))}


def test_rules_edge_cases(spark, golden):
    none = association_rules(golden.limit(0), 10, 0.5)
    assert none.columns == ["antecedent", "consequent", "confidence", "lift", "support"]
    assert none.isEmpty()


def test_rules_of_long_sets(spark):
    items = [f"i{n:02d}" for n in range(24)]
    rows = [(items, 9), *(([x for x in items if x != y], 10) for y in items), *(([x], 20) for x in items)]
    rules = association_rules(spark.createDataFrame(rows, "items array<string>, freq bigint"), 40, 0.8).collect()
    assert sorted(r["consequent"] for r in rules) == [[x] for x in items]
    assert all((len(r["antecedent"]), r["confidence"], r["lift"]) == (23, 0.9, 1.8) for r in rules)


def brute(baskets, share):
    counts = {}
    for basket in baskets:
        for size in range(1, len(basket) + 1):
            for combo in itertools.combinations(sorted(basket), size):
                counts[combo] = counts.get(combo, 0) + 1
    return {c: n for c, n in counts.items() if n >= len(baskets) * share}


@pytest.mark.parametrize("share", [0.05, 0.2, 0.55])
def test_itemset_operators_agree(spark, share):
    rng = random.Random(3)
    baskets = [sorted({rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))}) for _ in range(100)]
    want = brute(baskets, share)
    arrays = spark.createDataFrame([(f"o{i}", b + b[:1]) for i, b in enumerate(baskets)], "owner string, items array<string>")
    rows = arrays.select("owner", F.explode("items").alias("item"))
    as_dict = lambda df: {tuple(r["items"]): r["freq"] for r in df.collect()}
    assert as_dict(frequent_itemsets(arrays, share)) == want
    assert as_dict(levelwise_itemsets(arrays, share)) == want
    for chunks in (1, 3, 50 if share > 0.2 else 6):
        assert as_dict(two_pass_itemsets(arrays, share, chunks=chunks)) == want
    found, n = frequent_itemsets_of_holdings(rows, share)
    assert n == 100 and as_dict(found) == want


def test_mining_plan_and_split(spark):
    rng = random.Random(4)
    rows = spark.createDataFrame(
        [(f"o{i}", rng.choice("abcde")) for i in range(50) for _ in range(4)], "owner string, item string")
    split = owner_split(rows, 0.2, seed=1)
    parts = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert parts == {"test": 10, "train": 40}
    assert {r["owner"] for r in split.filter("split = 'test'").collect()} == {
        r["owner"] for r in owner_split(rows, 0.2, seed=1).filter("split = 'test'").collect()}
    mined = mine(rows, split=split)
    assert mined.n_owners == 40
    assert train_rows(rows, split).count() + held_out_rows(rows, split).count() == rows.count()
    assert mined.itemset_grid.filter("min_support = 0.05").count() == mined.itemsets.count()


def test_cleaning_rules(spark):
    rows = [
        Row(owner="w1", chain="ETH", token="Ether (ETH)", contract=None, name_tag=None),
        Row(owner="w1", chain="ETH", token="Ether (ETH)", contract="w1", name_tag=None),
        Row(owner="w1", chain="ETH", token="Ether (ETH)", contract="0x1", name_tag=None),
        Row(owner="w2", chain=None, token="Ether (ETH)", contract=None, name_tag=None),
        Row(owner="w2", chain="BSC", token="Coin, the (C)", contract=None, name_tag=None),
        Row(owner="w3", chain="BSC", token="X", contract="0x2", name_tag="Exchange"),
    ]
    df = spark.createDataFrame(rows, "owner string, chain string, token string, contract string, name_tag string")
    items = lambda strict: sorted(r["item"] for r in cl.clean_holdings(df, strict).collect())
    assert items(False) == ["BSC_Coin, the (C)", "ETH_Ether (ETH)_0x1", "Ether (ETH)"]
    assert items(True) == ["BSC_Coin, the (C)", "ETH_Ether (ETH)_0x1"]


def test_money(spark):
    texts = ["1,234.5", "$1,234.5", "<0.000001", "<$0.000001", "$<0.000001", "abc", None, "0", "-1", "5d", "NaN"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(tx.value_number(F.col("t"), 1e-6), tx.value_number(F.col("t")), tx.amount_number(F.col("t"))).collect()
    assert [r[0] for r in got] == [1234.5, 1234.5, 1e-6, 1e-6, 1e-6, None, None, 0.0, -1.0, None, None]
    assert [r[1] for r in got] == [1234.5, 1234.5, None, None, None, None, None, 0.0, -1.0, None, None]
    assert [r[2] for r in got] == [1234.5, None, None, None, None, None, None, 0.0, -1.0, None, None]
    with pytest.raises(Exception):
        df.filter("t = 'abc'").select(tx.amount_number(F.col("t"), strict=True)).collect()


def test_user_portfolio(spark):
    columns = "owner string, chain string, token string, contract string, amount string, value string"
    rows = [("w", "ETH", "A", "0x1", "1,000", "$3"), ("w", "ETH", "B", "w", "10", "$100.0"),
            ("w", "ETH", "C", None, "5", "<$0.000001"), ("w", "ETH", "D", None, "0", "$1"),
            ("w", "ETH", "Ether (ETH)", None, "5", "$5")]
    out = {r["item"]: r["ratio"] for r in cl.clean_user_portfolio(spark.createDataFrame(rows, columns)).collect()}
    assert out == {"ETH_A_0x1": 75.0, "ETH_B": 25.0}


def test_merge_and_total(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "owner string, x int")
    right = spark.createDataFrame([("a", "r1"), ("a", "r1"), ("b", "r2"), ("b", "r1")], "owner string, rank string")
    assert cl.left_merge(left, right).count() == 5
    merged = {(r["owner"], r["rank"]) for r in cl.left_merge(left, right, dedupe_right=True).collect()}
    assert merged == {("a", "r1"), ("b", "r1"), ("c", None)}
    user = spark.createDataFrame([("b", 9)], "owner string, x int")
    assert {(r[0], r[1]) for r in merge_user(left, user).collect()} == {("a", 1), ("b", 9), ("c", 3)}
    assert {r[0]: r[1] for r in cl.total_amount(left, "owner", "x").collect()} == {"a": 1, "b": 2, "c": 3}


def test_positions_and_duplicates(spark):
    rng = random.Random(2)
    rows = [(f"o{min(rng.randint(0, 9), 3)}", n, rng.choice("abcd")) for n in range(60)]
    df = spark.createDataFrame(rows, "owner string, ord int, item string")
    want, seen = {}, {}
    for owner, _, item in rows:
        place = seen[owner] = seen.get(owner, -1) + 1
        want.setdefault((owner, item), []).append(place)
    got = {(r["owner"], r["ord"]): r["pos"] for r in ordered_positions(df, "owner", ["ord"]).collect()}
    assert len(got) == 60 and sorted(got[k] for k in got if k[0] == "o0") == list(range(seen["o0"] + 1))
    dup = {(r["owner"], r["item"]): (r["count"], r["positions"]) for r in bk.duplicate_items(df, ["ord"]).collect()}
    expected = {k: (len(v), ",".join(map(str, v))) for k, v in want.items() if len(v) > 1}
    assert dup == expected
    grouped = bk.group_items(df, ["ord"])
    firsts = {r["owner"]: r["items"] for r in bk.make_baskets(df, ["ord"]).collect()}
    assert firsts == {r["owner"]: r["items"] for r in bk.drop_repeats(grouped).collect()}
    assert bk.owner_count(df).first()[0] == 4


def test_positions_of_one_busy_owner(spark):
    """Text order, equal keys and a null owner; the busy owner's rows lie in several ranges."""
    rows = [("busy", f"t{n:05d}", n) for n in range(5000)] + [("flat", "same", n) for n in range(400)] + [(None, "x", 1), (None, "y", 2)]
    df = spark.createDataFrame(rows, "owner string, ord string, n int").repartition(5)
    setting = "spark.sql.adaptive.coalescePartitions.enabled"  # else so few rows are put into one range
    spark.conf.set(setting, "false")
    try:
        ranges = df.orderBy("owner", "ord", F.xxhash64("owner", "ord", "n")).withColumn("part", F.spark_partition_id())
        assert ranges.filter("owner = 'busy'").select("part").distinct().count() > 2
        got = {}
        for row in ordered_positions(df, "owner", ["ord"]).collect():
            got.setdefault(row["owner"], []).append((row["pos"], row["ord"]))
    finally:
        spark.conf.unset(setting)
    assert sorted(got["busy"]) == [(n, f"t{n:05d}") for n in range(5000)]
    assert sorted(x[0] for x in got["flat"]) == list(range(400)) and sorted(got[None]) == [(0, "x"), (1, "y")]


def test_global_rank(spark):
    df = spark.range(1000).withColumn("x", F.pmod(F.col("id") * 37, F.lit(101)))
    got = [(r["x"], r["id"]) for r in global_rank(df.repartition(7), F.col("x").desc(), F.col("id")).orderBy("pos").collect()]
    assert got == sorted(got, key=lambda t: (-t[0], t[1])) and len(got) == 1000


def test_matching_and_blending(spark):
    rules = spark.createDataFrame(
        [(["a"], ["b"], 0.8, 2.0, 0.1), (["a", "b"], ["c", "d"], 0.5, 4.0, 0.1),
         (["e"], ["a"], 0.9, 1.0, 0.1), (["a"], ["b", "c"], 0.6, 1.0, 0.1)],
        "antecedent array<string>, consequent array<string>, confidence double, lift double, support double")
    held = spark.createDataFrame(
        [("u", "a"), ("u", "b"), ("u", "c"), ("v", "a"), ("v", "a"), ("w", "z")], "owner string, item string")
    matched = matching_rules(held, rules)
    got = {(r["owner"], tuple(r["antecedent"]), tuple(r["new_items"])) for r in matched.collect()}
    assert got == {("u", ("a", "b"), ("d",)), ("v", ("a",), ("b",)), ("v", ("a",), ("b", "c"))}
    assert {(r[0], r[1]) for r in new_items(matched).collect()} == {("u", "d"), ("v", "b"), ("v", "c")}
    scores = {(r[0], r[1]): r[2] for r in rule_scores(matched).collect()}
    assert scores == {("u", "c"): 2.0, ("u", "d"): 2.0, ("v", "b"): 1.6, ("v", "c"): 0.6}
    assert {(r[0], r[1]): r[2] for r in best_rule_scores(held, rules).collect()} == scores
    assert best_rule_scores(held.limit(0), rules).isEmpty() and matching_rules(held, rules.limit(0)).isEmpty()
    assert {(r[0], r[1]) for r in rule_scores(matched, held).collect()} == {("u", "d"), ("v", "b"), ("v", "c")}

    def table(*rows):
        return spark.createDataFrame(list(rows), "owner string, item string, score double")

    user = table(("v", "b", 1.0), *[("v", f"x{i:02d}", i / 10) for i in range(12)])
    blended = blend_scores(rule_scores(matched), user, table(("v", "b", 2.0), ("v", "c", 1.0)))
    best = {(r["owner"], r["item"]): (r["score"], r["methods"]) for r in blended.collect()}
    assert best["v", "b"] == (pytest.approx(3.2 + 1.5 + 3.5 + 20), 3)
    assert best["v", "c"] == (pytest.approx(1.2 + 1.75 + 10), 2)
    final = [r for r in diverse_top(blended, 10, seed=3).orderBy("rank").collect() if r["owner"] == "v"]
    assert [r["rank"] for r in final] == list(range(1, 11))
    assert [r["pick"] for r in final] == ["top"] * 8 + ["tail"] * 2
    assert [r["item"] for r in final][:3] == ["b", "c", "x11"]
    nine = [r for r in diverse_top(blended, 9).collect() if r["owner"] == "v"]
    assert len(nine) == 8
    assert len([r for r in diverse_top(blended, 10).collect() if r["owner"] == "u"]) == 2


def test_set_tree_looks_at_held_beginnings_only():
    tree = SetTree()
    for number, items in enumerate(itertools.combinations("abcdefghij", 3)):
        tree.add(list(items), number)
    found = [list(itertools.combinations("abcdefghij", 3))[n] for n in tree.inside(["b", "d", "e", "z"])]
    assert found == [("b", "d", "e")]
    assert tree.visited == 1 + 3 + 3 + 1  # the root, b d e, their pairs, the set; of 176 nodes


def test_busy_first_items_are_dealt_to_parts(spark):
    rng = random.Random(12)
    baskets = [(f"o{n}", sorted({"a"} | {rng.choice("bcdef") for _ in range(3)})) for n in range(90)]
    sets = [("a", "b"), ("a", "c", "d"), ("b", "e"), ("f",)]
    found = {}
    met = by_first_item(spark.createDataFrame([(list(s),) for s in sets], "items array<string>"),
                        spark.createDataFrame(baskets, "owner string, items array<string>"), part_baskets=20)
    sizes = met.applyInArrow(lambda s, b: pa.table({"sets": [len(s)], "n": [len(b)]}), "sets long, n long").collect()
    assert max(r["n"] for r in sizes) < 45 and sum(r["n"] for r in sizes if r["sets"] == 2) == 90
    pairs = spark.createDataFrame([(o, i) for o, items in baskets for i in items], "owner string, item string")
    for row in count_itemsets(pairs, spark.createDataFrame([(list(s),) for s in sets], "items array<string>")).collect():
        found[tuple(row["items"])] = row["freq"]
    assert found == {s: sum(set(s) <= set(items) for _, items in baskets) for s in sets}


def test_recommend_for_new_user(spark):
    rng = random.Random(6)
    rows = [(f"o{o:02d}", f"i{i}", float(rng.randint(1, 9)), float(rng.randint(1, 9)))
            for o in range(25) for i in range(14) if rng.random() < 0.4]
    columns = "owner string, item string, amount double, value double"
    holdings = spark.createDataFrame(rows, columns)
    user = spark.createDataFrame([("me", "i1", 2.0, 3.0), ("me", "i2", 1.0, 1.0), ("o01", "i3", 1.0, 1.0), ("o01", "i4", 1.0, 9.0)], columns)
    mined = mine(holdings, [0.1], [0.3])
    out = recommend(holdings, mined.rules, user=user, n=10, seed=1, exclude_held=True).collect()
    assert {r["owner"] for r in out} == {"me", "o01"}
    assert not {r["item"] for r in out if r["owner"] == "me"} & {"i1", "i2"}
    assert max(r["rank"] for r in out) == 10


def test_rmse(spark):
    a = spark.createDataFrame([("o", "x", 1.0), ("o", "y", 3.0)], "owner string, item string, score double")
    b = spark.createDataFrame([("o", "x", 2.0), ("o", "y", 3.0), ("o", "z", 1.0)], "owner string, item string, ratio double")
    row = rmse(a, b).first()
    assert row["n"] == 2 and row["rmse"] == pytest.approx(0.5**0.5)


def test_files(spark, tmp_path, golden):
    rules = association_rules(golden, BASKETS, 0.7)
    files.write_csv(rules, str(tmp_path / "rules"), one_file=True)
    back = files.read_rules_csv(spark, str(tmp_path / "rules"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rules.collect()))
    files.write_csv(golden, str(tmp_path / "sets"))
    assert files.read_itemsets_csv(spark, str(tmp_path / "sets")).count() == 46
    text = spark.createDataFrame([("['a', \"it's\"]",), ("bare",), ("'one'",), ("[]",)], "t string")
    lists = [r[0] for r in text.select(tx.list_from_text(F.col("t"))).collect()]
    assert lists == [["a", "it's"], ["bare"], ["one"], []]
    odd = spark.createDataFrame([(["a'b", "c\\d", "e, f"],)], "items array<string>")
    assert odd.select(tx.list_from_text(tx.text_from_list(F.col("items")))).first()[0] == ["a'b", "c\\d", "e, f"]
    folder = tmp_path / "merged.csv"
    folder.write_text(
        "Address,Chain,Token,Contract Address,Portfolio %,Price,Amount,Value,Rank,Name Tag,Balance,Percentage,Txn Count\n"
        'w1,ETH,"A, b (A)",,1%,$2,"1,000",$5,1,,9,1%,7\n')
    row = files.read_merged_csv(spark, str(folder)).first()
    assert (row["owner"], row["token"], row["contract"], row["amount"], row["name_tag"]) == ("w1", "A, b (A)", None, "1,000", None)
    plain = tmp_path / "baskets.csv"
    plain.write_text('Address,Items\nw1,"a,b"\n')
    assert files.read_baskets_csv(spark, str(plain)).first()["items"] == ["a", "b"]
    files.write_table(itemset_grid(golden, BASKETS), str(tmp_path / "grid"), ["min_support"])
    assert spark.read.parquet(str(tmp_path / "grid")).filter("min_support = 0.2").count() == 16


def test_pages(spark):
    cell = "<td> {} </td>"
    line = lambda *cells: "<tr>" + "".join(cell.format(c) for c in cells) + "</tr>"
    accounts = "<table><tr><th>Rank</th></tr>" + line(
        1, '<a href="/address/0xA">0x..</a>', "Big &amp; Co", "5", "1%", "3") + "</table><table><tr><td>no</td></tr></table>"
    portfolio = (
        '<table><tr><td>first</td></tr></table><TABLE id="js-chain-table"><thead><tr><td>h</td></tr></thead><tbody>'
        + line("ETH", '<a href="/token/0xC?a=1"><b>Coin</b> (C)</a><a href="/x">y</a>', "5%", "$1", "2", "$2")
        + line("BSC", "Native", "1%", "$1", "<", "&lt;$0.000001") + "</tbody></TABLE>")
    empty = '<table id="js-chain-table"></table>'
    rows = [(1, "https://h/accounts/1", accounts), (2, "https://h/address/0xB#multichain-portfolio", portfolio),
            (3, "https://h/address/0xD", empty), (4, "https://h/none", "<p>nothing</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = pages.extract_accounts(df.filter("page_id in (1, 4)")).collect()
    assert [(r["rank"], r["owner"], r["name_tag"], r["txn_count"]) for r in found] == [("1", "0xA", "Big & Co", "3")]
    held = pages.extract_portfolios(df).orderBy("row_no").collect()
    assert [(r["owner"], r["chain"], r["token"], r["contract"], r["value"]) for r in held] == [
        ("0xB", "ETH", "Coin (C)y", "0xC", "$2"), ("0xB", "BSC", "Native", None, "<$0.000001")]
    links = pages.page_links(df).filter("page_id = 2").orderBy("pos").collect()
    assert [(r["segment"], r["contract"]) for r in links] == [("0xC?a=1", "0xC"), ("x", "x")]


def test_links_owners_and_null_texts(spark):
    html = "<!-- <a href=\"/no\"> --><a href='/one'><A HREF=/two><a class=x href=\"/p?a=1&amp;b=2\">"
    df = spark.createDataFrame([(html, None)], "html string, text string")
    row = df.select(links_in_html("html").alias("links"), list_from_text(F.col("text")).alias("items")).first()
    assert row["links"] == ["/one", "/two", "/p?a=1&b=2"] and row["items"] is None


@pytest.mark.parametrize(
    ("html", "links"),
    [
        ('<a title="see href=foo" href="bar">', ["bar"]),
        ("<a title='a > b' href='x1'>", ["x1"]),
        ('<a href="/p?a=1&#38;b=2&quot;c&#x41;">', ['/p?a=1&b=2"cA']),
        ("<script>var x = '<a href=/no>';</script><style><a href=/no></style><a href=/yes>", ["/yes"]),
        ('<a data-href="no" href = bare/path?x=1 class=y>', ["bare/path?x=1"]),
        ("<a name=top><abbr href=no><A\nHREF='a\nb'>", ["a\nb"]),
        ("<!-- <a href=no> --><a href=''><a href=&amp;lt;>", ["", "&lt;"]),
        ("<a " + "x=1 " * 5000 + "href=far>", ["far"]),
        ("<a href='open", []),
    ],
)
def test_link_forms(spark, html, links):
    df = spark.createDataFrame([(1, html), (2, None), (3, "")], "page_id long, html string")
    assert [r["link"] for r in pages.page_links(df).orderBy("pos").collect()] == links


@pytest.mark.parametrize(
    ("text", "items"),
    [
        ("['a',\n 'b']", ["a", "b"]), ("['a', 1, None]", ["a", "1", "None"]), ('["it\'s", \'x\ny\']', ["it's", "x\ny"]),
        ("[]", []), ("plain, text", ["plain, text"]), ("", [""]), ("'one'", ["one"]), (" [ 'a' ] \n", ["a"]), (None, None),
    ],
)
def test_list_texts(spark, text, items):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(list_from_text(F.col("t"))).first()[0] == items


def test_short_rows_are_counted(spark):
    cell = "<td>{}</td>"
    rows = "".join("<tr>" + "".join(cell.format(f"{n}-{c}") for c in range(6 if n % 3 else 2)) + "</tr>" for n in range(90))
    page = f'<table id="js-chain-table"><tbody>{rows}</tbody></table>'
    df = spark.createDataFrame([(n, f"https://h/address/o{n}", page) for n in range(3)] + [(9, None, None)], "page_id long, url string, html string")
    seen = Observation("rows")
    assert pages.extract_portfolios(df, seen).count() == 180
    assert seen.get == {"rows": 270, "short_rows": 90}


def test_published_grids(spark, golden, tmp_path):
    place = str(tmp_path / "out")
    rules = association_rules(golden, BASKETS, 0.5)
    mined = Mined(BASKETS, golden, rules, itemset_grid(golden, BASKETS), rule_grid(rules))
    with pytest.raises(FileNotFoundError):
        published_grids(spark, place)
    for _ in range(2):  # a repeated run leaves no double rows
        publish_mined(mined, place)
    sets, cells = published_grids(spark, place)
    assert sets.count() == sum(row[0] for row in GRID.values()) and sets.select("min_support").distinct().count() == 16
    assert cells.count() == sum(sum(row[1:]) for row in GRID.values())
    assert cells.select("min_support", "min_confidence").distinct().count() == 64
    few = Mined(BASKETS, golden, rules, itemset_grid(golden, BASKETS, [0.2]), rule_grid(rules).limit(0))
    publish_mined(few, place)
    sets, cells = published_grids(spark, place)
    assert sets.count() == 16 and cells.isEmpty()  # cells without rows do not keep old ones
    assert manifest(spark, f"{place}/itemsets").first()["number"] == 2
    # a manifest that was not committed is not read
    (tmp_path / "out" / "itemsets" / "manifest-00000009").mkdir()
    assert published_grids(spark, place)[0].count() == 16
    drop_old_attempts(spark, f"{place}/itemsets")
    assert published_grids(spark, place)[0].count() == 16 and len(list((tmp_path / "out" / "itemsets").iterdir())) == 2


def test_raw_users_against_a_stored_model(spark):
    rng = random.Random(8)
    rows = [(f"o{o:02d}", f"i{i}", float(rng.randint(1, 9)), float(rng.randint(1, 9)))
            for o in range(30) for i in range(12) if rng.random() < 0.5]
    holdings = spark.createDataFrame(rows, "owner string, item string, amount double, value double")
    raw = [("me", None, "i1", "me", "2,000", "$3.5"), ("me", None, "i2", None, "1", "$1"), ("me", None, "i3", None, "0", "$1"),
           ("o01", None, "i4", "o01", "2", "$1,000"), ("gone", None, "i5", None, "x", "$1")]
    raw = spark.createDataFrame(raw, "owner string, chain string, token string, contract string, amount string, value string")
    user = spark.createDataFrame([("me", "i1", 2000.0, 3.5), ("me", "i2", 1.0, 1.0), ("o01", "i4", 2.0, 1000.0)], holdings.schema)
    rated = rated_cells(holdings)
    as_rows = lambda df: sorted((r["owner"], r["item"], round(r["ratio"], 12), round(r["mean_ratio"], 12)) for r in df.collect())
    assert as_rows(replaced_owners(rated, user)) == as_rows(rated_cells(merge_user(holdings, user)))
    rules = mine(holdings, [0.1], [0.3]).rules
    got = sorted(map(tuple, recommend_raw(rated, rules, raw, seed=1).collect()))
    assert got == sorted(map(tuple, recommend(holdings, rules, user=user, seed=1).collect()))
    assert {r[0] for r in got} == {"me", "o01"}
    want = new_items(matching_rules(user, rules))
    assert sorted(map(tuple, recommend_by_rules(raw, rules).collect())) == sorted(map(tuple, want.collect()))


def test_pages_to_baskets(spark):
    line = lambda *cells: "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"
    accounts = "<table><tr><th>Rank</th></tr>" + line(1, '<a href="/a/0xA">0xA</a>', "Big Co", "5", "1%", "3") + line(
        2, '<a href="/a/0xB">0xB</a>', "Big Co", "5", "1%", "3") + "</table>"
    body = (line("ETH", "Ether (ETH)", "1%", "$1", "2", "$2") + line("BSC", '<a href="/t/0xC?a=1">Coin</a>', "1%", "$1", "2", "$2")
            + line("BSC", "Self<a href=/t/{0}></a>", "1%", "$1", "1", "$1") + line("BSC", "Bad", "1%", "$1", "n/a", "$1")
            + line("BSC", '<a href="/t/0xC?a=1">Coin</a>', "1%", "$1", "3", "<$0.000001"))
    page = lambda owner: '<table id="js-chain-table"><tbody>' + body.replace("{0}", owner) + "</tbody></table>"
    rows = [(1, "https://h/accounts/1", accounts), (2, "https://h/address/0xA", page("0xA")), (3, "https://h/address/0xD#x", page("0xD"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = baskets_of_pages(df.filter("page_id = 1"), df.filter("page_id > 1"))
    assert [(r["owner"], r["items"]) for r in out.collect()] == [("0xD", ["BSC_Coin_0xC", "BSC_Self"])]


def test_one_reading_for_means(spark):
    """Row and column means come from one pass over the cells."""
    cells = spark.createDataFrame([("r1", "c1", 1.0), ("r1", "c2", 3.0), ("r2", "c1", 5.0)], "owner string, item string, v double")
    found = baseline(cells, "owner", "item", "v")
    assert found.mu.first()[0] == 3.0
    assert {r["row"]: r["row_bias"] for r in found.rows.collect()} == {"r1": -1.0, "r2": 2.0}
    assert {r["col"]: r["col_bias"] for r in found.cols.collect()} == {"c1": 0.0, "c2": 0.0}
    plan = baseline_means(cells, "owner", "item", "v")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1 and "Expand" in plan


def test_stored_tables_can_be_dropped(spark, tmp_path):
    kept = materialise(spark.range(5))
    folder = kept.inputFiles()[0].rpartition("/")[0].removeprefix("file://")
    assert os.path.isdir(folder) and kept.count() == 5
    drop_stored(spark)
    assert not os.path.exists(folder)
