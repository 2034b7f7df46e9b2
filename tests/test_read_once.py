"""Sources are read once, and candidates are counted without walking baskets."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cofferline.operators import itemsets, similarity
from cofferline.operators.itemsets import count_itemsets, frequent_itemsets
from cofferline.operators.ratings import investment_ratio
from cofferline.registry import spark_queries as sq
from cofferline.registry import views


def _counted(df, seen):
    """``df``, adding each of its rows to ``seen`` whenever it is made."""

    def told(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    return df.mapInArrow(told, df.schema)


def test_frequent_itemsets_make_baskets_once(spark):
    seen = spark.sparkContext.accumulator(0)
    baskets = spark.createDataFrame([(["a", "b", "a"],), (["b", "a"],), (["c"],), (None,)], "items array<string>")
    found = {tuple(r["items"]): r["freq"] for r in frequent_itemsets(_counted(baskets, seen), 0.5).collect()}
    assert found == {("a",): 2, ("b",): 2, ("a", "b"): 2} and seen.value == 4


def test_ratios_make_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)
    rows = [("x", "o", 1.0, 2.0), ("y", "o", 2.0, 3.0), ("z", None, 1.0, 1.0), ("z", "p", None, 1.0), ("z", "q", 0.0, 1.0)]
    made = _counted(spark.createDataFrame(rows, "item string, owner string, amount double, value double"), seen)
    out = investment_ratio(made)
    assert out.columns == ["owner", "item", "amount", "value", "asset_value", "portfolio_value", "ratio"]
    got = {(r["owner"], r["item"]): (r["portfolio_value"], r["ratio"]) for r in out.collect()}
    assert got == {("o", "x"): (8.0, 0.25), ("o", "y"): (8.0, 0.75), ("p", "z"): (None, None), ("q", "z"): (0.0, None)}
    assert seen.value == len(rows)


@pytest.mark.parametrize("part_sets", [3, 20_000])
def test_candidates_are_counted_from_bitmaps(spark, monkeypatch, part_sets):
    monkeypatch.setattr(itemsets, "_PART_SETS", part_sets)
    draw = random.Random(4)
    baskets = {f"o{at}": set(draw.sample("abcdef", draw.randint(0, 5))) for at in range(300)}
    sets = [list(s) for size in (1, 2, 3) for s in itertools.combinations("abcdefz", size)]
    rows = [(owner, item) for owner, held in baskets.items() for item in held]
    pairs = spark.createDataFrame(rows + rows[:50] + [("o1", None), (None, "y")], "owner string, item string")
    found = count_itemsets(pairs, spark.createDataFrame([(s,) for s in sets], "items array<string>"))
    want = {tuple(s): n for s in sets if (n := sum(set(s) <= held for held in baskets.values()))}
    assert {tuple(r["items"]): r["freq"] for r in found.collect() if r["freq"]} == want


def test_a_bucket_is_counted_by_bitmaps():
    bits = np.random.default_rng(1).integers(0, 256, (2, 4096), np.uint8)
    held = pa.table({"item": ["a", "b"], "bits": [row.tobytes() for row in bits]})
    out = itemsets._count_part(pa.table({"items": [["b"], ["a", "b"], ["a", "z"], ["a"]]}), held).to_pydict()
    one, two, both = (int(np.bitwise_count(x).sum()) for x in (bits[0], bits[1], bits[0] & bits[1]))
    assert dict(zip(map(tuple, out["items"]), out["n"])) == {("a",): one, ("a", "b"): both, ("a", "z"): 0, ("b",): two}


@pytest.mark.parametrize("query", ["user_neighbours_sparse", "user_weights_sparse"])
def test_sparse_neighbours_read_lines_once(spark, monkeypatch, query):
    seen = spark.sparkContext.accumulator(0)
    tables = {
        "lineitem": spark.createDataFrame(
            [(at // 3, at % 4, at % 2, float(1 + at), 2.0) for at in range(24)],
            "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double"),
        "orders": spark.createDataFrame([(at, at % 5) for at in range(8)], "o_orderkey long, o_custkey long"),
        "part": spark.createDataFrame([(at, f"t{at}", f"n{at}", "b") for at in range(4)],
                                      "p_partkey long, p_type string, p_name string, p_brand string"),
    }
    tables["lineitem"] = _counted(tables["lineitem"], seen)
    monkeypatch.setattr(views, "table", lambda _, __, name: tables[name])
    assert sq.QUERIES[query](spark, "").count() > 0
    assert seen.value == 24


def test_half_pairs_move_cells_once(spark):
    cells = [("r1", "k", 0.5), ("r2", "k", 0.25), ("r3", "k", -1.0), ("r1", "l", 2.0), ("r2", "l", 1.0), ("r4", "m", 1.0),
             ("r1", None, 3.0), ("r2", None, 3.0)]
    found = similarity._half_pairs(spark.createDataFrame(cells, "row string, key string, w double"))
    got = {(r["row"], r["other"]): r["dot"] for r in found.collect()}
    assert got == {("r1", "r2"): 2.125, ("r1", "r3"): -0.5, ("r2", "r3"): -0.25}
