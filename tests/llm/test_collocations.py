"""Phrases against counting every gram of every piece."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cofferline.llm import collocations, queries


def restated(rows, least, top):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            total[lang] += len(words)
            for size in range(1, 6):
                counts[lang].update(words[i : i + size] for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        n, held = total[lang], {g: c for g, c in f.items() if c >= least and len(g) > 1}
        inside = {(g[i : i + size], c) for g, c in held.items() for size in range(2, len(g)) for i in range(len(g) - size + 1)}
        ranked = []
        for g, a in held.items():
            if (g, a) not in inside:
                score, k = min((1000 * a * n // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
                ranked.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def corpus(seed):
    rng, rows = random.Random(seed), [(None, "New York. new york"), ("en", None), (None, None), ("de", ""), ("de", " \t "), ("xx", "a " * 5000)]
    phrases = ["the quick brown fox jumps over", "New York", "in spite of", "Ä ö ü\x1cz", "a b a b a b", "q q q q q q q"]
    for _ in range(300):
        parts = []
        for _ in range(rng.choice([1, 4, 30])):
            parts.append(rng.choice(phrases) if rng.random() < 0.4 else rng.choice("abcdefghij"))
            parts.append(rng.choice([" ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", " ! "]))
        rows.append((rng.choice(["en", "en", "de", None, "und"]), "".join(parts)))
    return rows + rows[10:60]


@pytest.mark.parametrize(("short", "chunk", "top"), [(1 << 16, 2_000_000, 2000), (5, 50, 7)])
def test_against_all_grams(spark, monkeypatch, short, chunk, top):
    monkeypatch.setattr(collocations, "_CHUNK_WORDS", chunk)
    monkeypatch.setattr(collocations, "_MEMORY", 20 if chunk == 50 else 1_000_000)
    rows = corpus(chunk)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5).withColumn("n", F.lit("clash")).withColumn("hash", F.lit(0))
    got = sorted(tuple(r) for r in collocations.collocations(df, least=10, top=top, short=short).collect())
    assert got == restated(rows, 10, top) and len(got) > 15


def test_query(spark, tmp_path):
    rows = [("en", "good morning all, " * 40 + "good day. " * 30), ("fr", "bon jour " * 60)] * 3
    spark.createDataFrame(rows, "lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(tuple(r) for r in queries.op11_collocations(spark, str(tmp_path)).collect()) == restated(rows, 100, 2000)


def test_no_rows_and_large_numbers(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(spark.createDataFrame([("en", "seldom seen")], "lang string, text string")).count() == 0
    ids = "bigint, ".join(collocations._GRAM).replace("g", "g")
    schema = f"{ids} bigint, n bigint".replace("bigint,", " bigint,")
    a, l, r, n = 7_000_000_000_001, 9_000_000_000_007, 8_000_000_000_009, 90_000_000_000_000_000
    grams = spark.createDataFrame([(1, 2, 0, 0, 0, a), (1, 0, 0, 0, 0, l), (2, 0, 0, 0, 0, r)], schema)
    totals = spark.createDataFrame([(1, "en", n)], "hash bigint, lang string, total bigint")
    row = collocations._scored(collocations.compacted(grams), grams, totals).first()
    assert (row.a, row.l, row.r, row.n, row.score) == (a, l, r, n, 1000 * a * n // (l * r))


def test_two_words_with_one_hash(spark, monkeypatch):
    """The vocabulary is made anew with another seed."""
    rows = [("en", "left right " * 20 + "up down " * 20)]
    df = spark.createDataFrame(rows, "lang string, text string")
    usual = collocations._hash_words

    def clashing(seed):
        def hashed(batches):
            for batch in usual(seed)(batches):
                same = collocations.pa.array([10**6] * len(batch), collocations.pa.int64())
                yield collocations.pa.RecordBatch.from_arrays([*batch.columns[:3], same if seed == 0 else batch.column(3)], batch.schema.names)

        return hashed

    monkeypatch.setattr(collocations, "_hash_words", clashing)
    assert collocations._vocabulary(df, 2)[1] == 1
    assert sorted(tuple(r) for r in collocations.collocations(df, least=10).collect()) == restated(rows, 10, 2000)
