"""Rules meet many baskets at a time, with the results of going basket by basket, and rows are made once."""

import itertools
import random

import pyarrow as pa
import pytest

from cofferline.operators import match
from cofferline.operators.settree import SetTree
from cofferline.registry import spark_queries as sq
from cofferline.registry import views


def test_rules_are_met_by_columns_of_baskets(monkeypatch):
    monkeypatch.setattr(match, "_SLICE_BASKETS", 40)
    # one by one: a walk for every basket
    monkeypatch.setattr(SetTree, "inside", lambda *_: pytest.fail("a basket was walked by itself"))
    draw = random.Random(8)
    baskets = [sorted({"a", *draw.sample("bcdefgh", draw.randint(0, 6))}) for _ in range(130)]
    sides = [(["a", *more], draw.sample("bcdefghz", size)) for n in range(4) for more in itertools.combinations("bcde", n)
             for size in (1, 2, 3)]
    sides = [(x, [i for i in y if i not in x] or ["z"]) for x, y in sides] + [(["a", "a"], ["z"])]
    lifts = [draw.random() for _ in sides[1:]] + [None]
    rules = pa.table({"_path": [x for x, _ in sides], "antecedent": [x for x, _ in sides], "consequent": [y for _, y in sides],
                      "confidence": [0.5] * len(sides), "lift": pa.array(lifts, pa.float64()), "support": [0.1] * len(sides)})
    table = pa.table({"owner": [f"o{at}" for at in range(130)], "items": baskets, "place": pa.array([0] * 130, pa.int32())})
    want, best = [], {}
    for at, items in enumerate(baskets):
        for (x, y), lift in zip(sides[:-1], lifts):
            new = sorted(set(y) - set(items))
            if set(x) <= set(items) and new:
                want.append((f"o{at}", tuple(x), tuple(y), tuple(new)))
                for item in y if lift is not None else ():
                    best[f"o{at}", item] = max(best.get((f"o{at}", item), 0.0), lift * 0.5)
    out = match._matches(rules, table).to_pylist()
    assert sorted((r["owner"], *(tuple(r[c]) for c in ("antecedent", "consequent", "new_items"))) for r in out) == sorted(want)
    assert {(r["owner"], r["item"]): r["score"] for r in match._best_scores(rules, table).to_pylist()} == pytest.approx(best)
    nothing = table.slice(0, 0), rules.slice(0, 0)
    assert len(match._matches(nothing[1], table)) == len(match._best_scores(nothing[1], table)) == 0
    assert len(match._matches(rules, nothing[0])) == len(match._best_scores(rules, nothing[0])) == 0


@pytest.mark.parametrize("query", ["rule_matches", "suggested_items"])
def test_matches_make_rows_once(spark, monkeypatch, query):
    seen = spark.sparkContext.accumulator(0)
    rows = [(f"o{at}", item, 1.0, 1.0) for at in range(9) for item in ("ab" if at % 3 else "a")]

    def told(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    schema = "owner string, item string, amount double, value double"
    made = spark.createDataFrame(rows, schema).mapInArrow(told, schema)
    monkeypatch.setattr(views, "name_items", lambda *_: made)
    found = {r["owner"] for r in sq.QUERIES[query](spark, "").collect()}
    assert found == {"o0", "o3", "o6"} and seen.value == len(rows)
