"""Runs of words against trying every period, and the registered query against its contract restated."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cofferline.llm import periodic_runs, queries


def all_runs(words, least=6):
    """Every maximal stretch with its smallest period, by trying all periods."""
    found = {}
    for period in range(1, len(words) // 4 + 1):
        at = 0
        while at + period < len(words):
            end = at
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            if end + period - at >= max(least, 4 * period):
                found.setdefault((at, end + period), period)
            at = max(end, at + 1)
    return sorted((start, period, end) for (start, end), period in found.items())


def test_random_words():
    rng, documents = random.Random(3), []
    for _ in range(1500):
        kinds, n = rng.choice([1, 2, 3, 6]), rng.choice([0, 1, 5, 6, 7, 40, 150, rng.randint(64, 127)])
        words = [rng.randrange(kinds) for _ in range(n)]
        if n and rng.random() < 0.5:
            first, period = rng.randrange(n), rng.randint(1, max(1, n // 4))
            words = [w if i < first else words[first + (i - first) % period] for i, w in enumerate(words)]
            words += [rng.randrange(kinds) for _ in range(rng.randrange(9))] + words[:: rng.choice([1, -1])]
        documents.append(words)
    got = periodic_runs.runs_of([np.array(d, np.int64) for d in documents], 6)
    for words, (start, end, period) in zip(documents, got, strict=True):
        assert list(zip(start.tolist(), period.tolist(), end.tolist(), strict=True)) == all_runs(words)


def test_long_document():
    words = np.concatenate((np.arange(500), np.tile(np.arange(7, 3007), 12), np.zeros(90_000, np.int64)))
    start, end, period = periodic_runs.runs_of([words], 6)[0]
    assert list(zip(start.tolist(), end.tolist(), period.tolist(), strict=True)) == [(500, 36_500, 3000), (36_500, 126_500, 1)]


def restated(doc_id, text):
    words = (text or "").encode().split()
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = all_runs(words)
    gone = {i for start, period, end in runs for i in range(start + period, end)}
    best = min(runs, key=lambda r: (r[0] - r[2], r[0], r[1]), default=None)
    told = (best[0], best[2] - best[0], best[1], 1000 * (best[2] - best[0]) // best[1]) if best else (None,) * 4
    lines = "".join(f"{s},{e - s},{p}\n" for s, p, e in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *told, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng, rows = random.Random(8), [(None, "a b " * 30), (-4, "x y\x1cz   é " * 9), (7, None), (8, ""), (9, " \t\n "), (11, "no no no no no")]
    for n in range(20, 260):
        letters = rng.choice(["ab", "abcdefg"])
        words = [rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 30, 200]))]
        rows.append((n, rng.choice([" ", "\n", "\t\x0b "]).join(words)))
    rows += rows[30:40] + [(500, "the end " * 3000)]
    place = str(tmp_path_factory.mktemp("runs"))
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{place}/documents.parquet")
    return place, rows


def test_query(spark, folder):
    place, rows = folder
    got = [tuple(r) for r in queries.op12_periodic_runs(spark, place).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, str(r))
    assert sorted(got, key=key) == sorted((restated(*r) for r in rows), key=key)
    assert sum(r[1] > 0 for r in got) > 20


def test_edge_cases(spark):
    df = spark.createDataFrame([(1, "a b a b a b a b c", "old", 3), (None, None, "old", None)], "doc_id int, text string, found string, runs int")
    out = periodic_runs.find_runs(df)
    assert sorted(out.columns) == sorted(df.columns)
    first, second = sorted(out.collect(), key=lambda r: r.doc_id is None)
    assert [tuple(r) for r in first.found.runs] == [(0, 8, 2)] and first.found.collapsed == "a b c" and first.runs == 3
    assert list(second.found.runs) == [] and second.found.collapsed == ""
    assert periodic_runs.find_runs(df.limit(0)).count() == 0
    beside = periodic_runs.find_runs(df.withColumn("body", F.col("text")), F.upper("body"), found="runs").filter("doc_id = 1").first()
    assert beside.runs.collapsed == "A B C" and beside.found == "old"
