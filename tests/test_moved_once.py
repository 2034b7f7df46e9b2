"""What is shuffled and written follows the rows: lines are moved once by owner, and no copy of a row is made to find its nearest rows."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cofferline.operators import similarity
from cofferline.operators.predict import item_scores, user_scores
from cofferline.operators.ratings import build_ratings, rated_cells
from cofferline.plans.evaluate import compare_methods, hold_out, rmse
from cofferline.plans.recommend import item_neighbourhood, stored_ratings, user_neighbourhood
from cofferline.registry import spark_queries as sq
from cofferline.registry import views


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(df):
    return len(re.findall(r"\bExchange\b", _plan(df)))


def test_rated_cells_move_rows_once(spark):
    rows = [("o1", "a", 1.0, 2.0), ("o1", "a", 1.0, 1.0), ("o1", "b", 1.0, 1.0), ("o2", "a", 1.0, 4.0), ("o3", "c", 0.0, 4.0),
            (None, "a", 1.0, 1.0), ("o4", None, 1.0, 1.0), ("o4", "a", 3.0, 1.0), ("o5", "a", None, 1.0)]
    rated = rated_cells(spark.createDataFrame(rows, "owner string, item string, amount double, value double"))
    assert _exchanges(rated) == 1
    got = {(r["owner"], r["item"]): (r["ratio"], r["mean_ratio"], r["length"]) for r in rated.collect()}
    third = (0.75 - 1 / 3) ** 2 + (0.25 - 1 / 3) ** 2
    assert got == {
        ("o1", "a"): (0.75, pytest.approx(1 / 3), pytest.approx(third**0.5)),
        ("o1", "b"): (0.25, pytest.approx(1 / 3), pytest.approx(third**0.5)),
        ("o2", "a"): (1.0, 1.0, None), ("o3", "c"): (None, None, None),
        ("o4", None): (0.25, 0.5, pytest.approx(0.125**0.5)), ("o4", "a"): (0.75, 0.5, pytest.approx(0.125**0.5)),
    }


def test_cells_with_lengths_are_not_moved(spark):
    cells = spark.createDataFrame([("o", "a", 3.0, 5.0), ("o", "b", 4.0, 5.0), ("p", "a", 0.0, 0.0)],
                                  "owner string, item string, centred double, length double")
    unit = similarity.unit_rows(cells, "owner", "item", "centred", "length")
    assert _exchanges(unit) == 0
    assert sorted(map(tuple, unit.collect())) == [("o", "a", 0.6), ("o", "b", 0.8)]


def _packed(spark, full):
    rows = [(f"r{at:03d}", at, [int(k) for k in np.flatnonzero(row)], [float(w) for w in row[row != 0]]) for at, row in enumerate(full)]
    return spark.createDataFrame(rows, "row string, no long, keys array<long>, ws array<double>")


@pytest.mark.parametrize("wanted", [None, ["r003", "r050", "nobody"]])
def test_blocks_meet_without_copies_of_rows(spark, wanted):
    rng = np.random.default_rng(5)
    full = np.where(rng.random((120, 9)) < 0.6, rng.normal(size=(120, 9)), 0.0)
    full[:, 0] += 0.01
    full /= np.linalg.norm(full, axis=1, keepdims=True)
    full[10] = full[11] = full[12] = full[13] = full[14]  # ties go by name
    chosen = None if wanted is None else spark.createDataFrame([(name,) for name in wanted], "row string")
    met = similarity._met(_packed(spark, full), chosen, 3, 80)
    plan = _plan(met)
    assert "CartesianProduct" in plan and "Exchange" not in plan
    sims = np.round(full @ full.T, similarity.DIGITS)
    np.fill_diagonal(sims, -2.0)
    best = {}
    for row, other, sim, rank in similarity._best(met, 3).select("row", "other", "sim", "rank").collect():
        best.setdefault(row, {})[rank] = (other, sim)
    names = [f"r{at:03d}" for at in range(120)]
    assert set(best) == set(names if wanted is None else wanted[:2])
    for row, found in best.items():
        order = sorted(range(120), key=lambda at: (-sims[int(row[1:]), at], names[at]))[:3]
        for rank, at in enumerate(order, 1):
            sim = sims[int(row[1:]), at]
            if sim > 0:
                assert found[rank][1] == pytest.approx(sim, abs=1e-9)
                if row in ("r010", "r012", "r014"):
                    assert found[rank][0] == names[at]


def test_related_rows_are_counted_over_all_blocks(spark):
    full = np.eye(8)[[0, 1, 2, 3, 4, 5, 6, 6]]
    full[0] = [0.5, 0.5, 0.5, 0.5, 0, 0, 0, 0]
    full[1] = [0, 1, 0, 0, 0, 0, 0, 0]
    full[2, :] = [-1, 0, 0, 0, 0, 0, 0, 0]
    met = similarity._met(_packed(spark, full), None, 3, 2)
    got = {}
    for row in similarity._best_of_scores(met, 3).collect():
        got.setdefault(row["row"], set()).add((row["other"], round(row["sim"], 9), row["n_related"]))
    assert got["r000"] == {("r001", 0.5, 3), ("r003", 0.5, 3), ("r002", -0.5, 3)}
    assert got["r006"] == {("r007", 1.0, 1)} and "r004" not in got


def test_hot_keys_are_exact(spark, monkeypatch):
    monkeypatch.setattr(similarity.F, "hash", lambda key: F.lit(1))  # all keys under one short hash
    unit = spark.range(60).select(F.col("id").cast("string").alias("row"), F.when(F.col("id") < 40, "hot").otherwise(F.col("id").cast("string")).alias("key"), F.lit(1.0).alias("w"))
    assert [r["key"] for r in similarity._hot_keys(unit, 30).collect()] == ["hot"]
    assert similarity._hot_keys(unit, 60).isEmpty()


def test_pairs_from_both_ends_are_summed_where_a_row_stands(spark):
    cells = [("r1", "k", 0.5), ("r2", "k", 0.25), ("r3", "k", -1.0), ("r1", "l", 2.0), ("r2", "l", 1.0)]
    found = similarity._both_pairs(spark.createDataFrame(cells, "row string, key string, w double"))
    assert _exchanges(similarity._best_of_scores(found.selectExpr("row", "other", "dot as sim", "1L as n_block"), 2)) == 2
    got = {(r["row"], r["other"]): r["dot"] for r in found.collect()}
    half = {("r1", "r2"): 2.125, ("r1", "r3"): -0.5, ("r2", "r3"): -0.25}
    assert got == half | {(b, a): dot for (a, b), dot in half.items()}


def test_compared_methods_read_holdings_once(spark):
    draw = random.Random(6)
    rows = [(f"o{n}", draw.choice([*"abcdef", None]), float(draw.randint(1, 4)), draw.choice([1.0, 2.0, None])) for n in range(60) for _ in range(8)]
    rows += [(None, "a", 1.0, 1.0), ("zero", "a", 0.0, 1.0), ("none", "b", None, 1.0)]
    made = spark.createDataFrame(rows, "owner string, item string, amount double, value double")
    seen = spark.sparkContext.accumulator(0)

    def told(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    got = {r["method"]: (r["n"], r["rmse"]) for r in compare_methods(made.mapInArrow(told, made.schema), 3, 0.4, 0.3, 5).collect()}
    assert seen.value == len(rows)
    visible, hidden = hold_out(made, 0.4, 0.3, 5)
    wanted = hidden.select("owner", "item").distinct()
    ratings = stored_ratings(visible)
    actual = build_ratings(made).cells.join(wanted, ["owner", "item"], "left_semi")
    users, items = user_neighbourhood(ratings, 3), item_neighbourhood(ratings, 3)
    for method, scores in (("user", user_scores(wanted, ratings, users.weights, users.base)), ("item", item_scores(wanted, ratings, items.weights, items.base))):
        row = rmse(scores, actual).first()
        assert got[method][0] == row["n"] > 0 and got[method][1] == pytest.approx(row["rmse"], abs=1e-9)


def test_new_users_read_lines_once(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def told(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    lines = spark.createDataFrame([(at // 3, at % 7, float(1 + at % 5), 2.0 + at % 3) for at in range(90)],
                                  "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double")
    tables = {
        "lineitem": lines.mapInArrow(told, lines.schema),
        "orders": spark.createDataFrame([(at, at % 9) for at in range(30)], "o_orderkey long, o_custkey long"),
        "part": spark.createDataFrame([(at, "t", f"n{at}", "b") for at in range(7)], "p_partkey long, p_type string, p_name string, p_brand string"),
        "customer": spark.createDataFrame([(at, "BUILDING" if at % 3 == 0 else "OTHER") for at in range(9)], "c_custkey long, c_mktsegment string"),
    }
    monkeypatch.setattr(views, "table", lambda _, __, name: tables[name])
    assert {r["owner"] for r in sq.recommend_new_users(spark, "").collect()} <= {"0", "3", "6"}
    assert seen.value == 90


def test_null_keys_meet_nobody(spark):
    rng = np.random.default_rng(2)
    full = rng.normal(size=(12, 4))
    rows = [(f"o{at:02d}", key, float(v)) for at, row in enumerate(full) for key, v in zip(["a", "b", "c", None], row)]
    near = similarity.top_neighbours(spark.createDataFrame(rows, "owner string, item string, v double"), 2, "owner", "item", "v", max_fanout=3, block_cells=12)
    unit = full / np.linalg.norm(full, axis=1, keepdims=True)
    sims = unit[:, :3] @ unit[:, :3].T
    np.fill_diagonal(sims, -2.0)
    got = {(r["row"], r["rank"]): (r["other"], r["sim"]) for r in near.collect()}
    for at in range(12):
        for rank, to in enumerate(np.argsort(-sims[at])[:2], 1):
            if sims[at, to] > 0:
                assert got[f"o{at:02d}", rank] == (f"o{to:02d}", pytest.approx(sims[at, to], abs=1e-9))
