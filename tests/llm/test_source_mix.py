"""Targets, tilts and copies against plain restatements."""

import math
import random
from collections import defaultdict

import pytest

from cofferline.llm import queries, source_mix


def shared(sizes, weights, most=3.0):
    """Targets by passing what is above the bounds on, round by round."""
    target, full = {}, set()
    while True:
        free = [s for s in sizes if s not in full]
        left = sum(sizes.values()) - sum(most * sizes[s] for s in full)
        for s in sizes:
            target[s] = most * sizes[s] if s in full else left * weights[s] / sum(weights[f] for f in free)
        above = {s for s in free if target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above


def tilted(sizes, target, most=3.0):
    """The tilt by halving."""
    low, high = -50.0, 50.0
    for _ in range(300):
        mid = (low + high) / 2
        if sum(z * min(most, math.exp(min(mid * z, 50.0))) for z in sizes) < target:
            low = mid
        else:
            high = mid
    return high


def corpus(seed, n=400):
    rng, rows = random.Random(seed), [(None, None, None), (-1, "only", None), (-2, "blank", " \t\n")]
    for doc in range(n):
        source = rng.choice(["b", "b", "b", "b", "a", "é", "z", None])
        rows.append((doc, source, " \t".join(["w"] * rng.choice([0, 1, 3, 10, 10, 50, 400]))))
    return rows + rows[5:30] + [(n, "small", "one two three")]


@pytest.mark.parametrize("seed", [1, 2])
def test_mix(spark, tmp_path, seed):
    rows = corpus(seed)
    spark.createDataFrame(rows, "doc_id bigint, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [r.asDict() for r in queries.op13_source_mix(spark, str(tmp_path)).collect()]
    again = [r.asDict() for r in queries.op13_source_mix(spark, str(tmp_path)).collect()]
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["taken"])
    assert sorted(got, key=key) == sorted(again, key=key)
    assert sorted(map(str, (r["doc_id"] for r in got))) == sorted(str(r[0]) for r in rows)
    source_of = {r[0]: r[1] for r in rows}
    by_source, sizes = defaultdict(list), defaultdict(int)
    for doc, source, text in rows:
        sizes[source] += len((text or "").split())
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    want = shared(dict(sizes), {s: 1.0 + n % 3 for n, s in enumerate(names)})
    for row in got:
        source = source_of[row["doc_id"]]
        assert row["source_size"] == sizes[source] and row["target"] == pytest.approx(want[source], rel=1e-12)
        assert 0 <= row["taken"] <= 3 * row["size"] and row["taken"] == row["copies"] * row["size"]
        by_source[source].append(row)
    for source, some in by_source.items():
        taken, least = sum(r["taken"] for r in some), min((r["size"] for r in some if r["size"]), default=0)
        assert abs(taken - want[source]) <= max(least / 2, 1e-6)
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))


def test_tilts_are_those_of_the_dual(spark):
    rng = random.Random(4)
    sizes = {"low": [rng.choice([1, 5, 40, 300]) for _ in range(200)], "high": [rng.choice([2, 9, 900]) for _ in range(90)], "even": [7] * 20, "max": [3, 4]}
    target = {"low": 0.2 * sum(sizes["low"]), "high": 2.7 * sum(sizes["high"]), "even": 1.5 * 140, "max": 21.0}
    counts = spark.createDataFrame([(s, z, zs.count(z)) for s, zs in sizes.items() for z in set(zs)], "source string, size bigint, documents bigint")
    wanted = spark.createDataFrame([(s, sum(zs), target[s]) for s, zs in sizes.items()] + [("none", 0, 0.0)], "source string, source_size bigint, target double")
    found = {r.source: r for r in source_mix.tilts(counts, wanted).collect()}
    assert set(found) == {*sizes, "none"}
    for source, zs in sizes.items():
        tilt = found[source].tilt / found[source].scale
        words = sum(z * min(3.0, math.exp(tilt * z)) for z in zs)
        assert words == pytest.approx(target[source], abs=0.3)
        if source != "max":
            assert tilt == pytest.approx(tilted(zs, target[source]), rel=1e-2)


def test_given_weights_and_edge_cases(spark):
    df = spark.createDataFrame([(1, "a", "x y"), (2, "b", "x y z"), (3, "b", None)], "id int, kind string, body string")
    df = df.withColumnsRenamed({"id": "size", "kind": "target", "body": "copies"})  # names of the result
    weights = spark.createDataFrame([("a", 1.0), ("b", 4.0)], "source string, weight double")
    out = {r.size_: r for r in source_mix.mix(df, weights, key="size", source="target", text="copies").toDF("size_", "s", "n", "ss", "t", "c").collect()}
    assert [out[n].t for n in (1, 2, 3)] == [1.0, 4.0, 4.0] and out[3].c == 0
    empty = source_mix.mix(df.limit(0), key="size", source="target", text="copies")
    assert empty.count() == 0


def test_copies_of_one_size_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(source_mix, "_PER_BUCKET", 7)
    df = spark.range(500).selectExpr("id AS doc_id", "IF(id < 400, 'a', 'b') AS source", "'two words' AS text")
    rows = source_mix.mix(df, (1.0, 1.0)).collect()
    assert sum(r.copies for r in rows if r.source == "b") == 250 and {r.copies for r in rows if r.source == "b"} == {2, 3}
    assert sum(r.copies for r in rows if r.source == "a") == 250 and {r.copies for r in rows if r.source == "a"} == {0, 1}
