"""Phrase collocations from a weighted de Bruijn graph.

Nodes are sequences of four words, edges the five-word grams that lead from one to the next, weighted
by their occurrences. Pieces of text are walks: every place of a piece adds the edge that starts
there, and at the end of a piece, where no edge is left, the shorter grams that close it. These are
the piece-end corrections: a node's count is the flow on its outgoing edges plus the walks that end in
it, and so on down to single words. Sorted by their words, the edges and corrections of a partition
hold all flows as sums over common beginnings, which one pass takes; beginnings that two neighbouring
partitions share are summed afterwards, so no node is gathered, however heavy.

Nodes all of whose flow runs along one edge are compacted into it: the phrase of such a node lies in a
longer one of the same count.

Words are 64-bit hashes of language and word. Whether two words share one is looked up for the whole
vocabulary; if so, all is counted with another seed. A bounded number of the most frequent words have small
numbers instead, which shuffles pack better.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cofferline.llm.common import stored, values_of

MOST_WORDS = 5
_GRAM = [f"g{n}" for n in range(1, MOST_WORDS + 1)]
_EDGES = ", ".join(f"{g} bigint" for g in _GRAM) + ", n bigint"
_VOCABULARY = "lang string, word string, n bigint"
_HASHED = "lang string, word string, n bigint, hash bigint"
_CHUNK_WORDS = 2_000_000  # below 2**21: three words of a chunk fit one number
_SAMPLE_TEXTS, _SAMPLE_STEP = 2000, 50  # where partitions begin is read from every 50th edge of some texts
_MEMORY = 1_000_000  # hashes a task remembers
_SHORT = 1 << 16  # words with small numbers: half a megabyte, whatever the data

# fixed: separators of pieces and of words, in bytes
_TABLE = bytearray(range(256))
_TABLE[65:91] = bytes(range(97, 123))
_TABLE[9] = 32
for _mark in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_mark] = 10
_TABLE = bytes(_TABLE)


# -- texts ------------------------------------------------------------------------------------


class WordHashes(dict):
    """64-bit hashes of the words of one language, or the small numbers given for some of them."""

    def __init__(self, lang: str, seed: int, short: dict[int, int] | None = None):
        self.start, self.seed, self.short = lang.encode() + b"\0", seed, short or {}

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(self.start + word, self.seed)
        value = value - (1 << 64) if value >> 63 else value
        self[word] = value = self.short.get(value, value)
        return value


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[list[bytes]]]]:
    """Language and pieces of every document, each piece a list of words."""
    for batch in batches:
        for lang, text in zip(values_of(batch.column(0)), values_of(batch.column(1)), strict=True):
            if text:
                yield lang, [words for words in map(bytes.split, text.encode().translate(_TABLE).split(b"\n")) if words]


def _walks(batches: Iterator[pa.RecordBatch], seed: int, short: dict[int, int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of a chunk of words, and how many words of the piece are left at each, itself included."""
    memories: dict[str, WordHashes] = {}
    hashes, sizes = [], []
    for lang, pieces in _pieces(batches):
        memory = memories.setdefault(lang, WordHashes(lang, seed, short))
        for words in pieces:
            hashes.extend(map(memory.__getitem__, words))
            sizes.append(len(words))
        if len(memory) > _MEMORY:
            memory.clear()
        if len(hashes) > _CHUNK_WORDS:
            yield _chunk(hashes, sizes)
            hashes, sizes = [], []
    if hashes:
        yield _chunk(hashes, sizes)


def _chunk(hashes: list[int], sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array(sizes)
    ends = np.repeat(np.cumsum(sizes), sizes)
    return np.array(hashes, np.int64), ends - np.arange(len(ends))


def _grams_at(words: np.ndarray, left: np.ndarray, first: int, stop: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct edges and closing grams that start at the places ``first`` to ``stop``, in the order of
    their words, and how often each does."""
    words, left = words[first : stop + MOST_WORDS - 1], left[first:stop]
    # numbers in the order of the words, 21 bits each; the last word is the end of a gram
    names, numbers = np.unique(np.append(words, 0), return_inverse=True)
    numbers = numbers.astype(np.uint64)
    none, parts = numbers[-1], []
    for n in range(MOST_WORDS):
        after = numbers[n : n + len(left)]
        parts.append(np.where(left > n, np.append(after, np.full(len(left) - len(after), none)), none))
    high = parts[0] << np.uint64(42) | parts[1] << np.uint64(21) | parts[2]
    low = parts[3] << np.uint64(21) | parts[4]
    order = np.lexsort((low, high))
    new = np.concatenate(([True], (np.diff(high[order]) != 0) | (np.diff(low[order]) != 0)))[: len(order)]
    begin = np.flatnonzero(new)
    return [names[part[order[begin]].astype(np.int64)] for part in parts], np.diff(np.append(begin, len(order)))


def _batches(columns: list[np.ndarray], names: list[str], rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns[0]), rows):
        yield pa.RecordBatch.from_arrays([pa.array(c[at : at + rows], pa.int64()) for c in columns], names)


# -- passes over the texts ---------------------------------------------------------------------


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[str, Counter[bytes]] = {}
    held = 0

    def told() -> Iterator[pa.RecordBatch]:
        for lang, words in seen.items():
            names = pa.array([name.decode() for name in words], pa.string())
            langs = pa.array([lang] * len(words), pa.string())
            yield pa.RecordBatch.from_arrays([langs, names, pa.array(words.values(), pa.int64())], ["lang", "word", "n"])

    for lang, pieces in _pieces(batches):
        words = seen.setdefault(lang, Counter())
        held -= len(words)
        words.update(chain.from_iterable(pieces))
        held += len(words)
        if held > _MEMORY:
            yield from told()
            seen, held = {}, 0
    yield from told()


def _hash_words(seed: int):
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [WordHashes(lang, seed)[word.encode()] for lang, word in zip(*(batch.column(n).to_pylist() for n in (0, 1)), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], ["lang", "word", "n", "hash"])

    return hashed


def _make_edges(seed: int, short, bounds: list[tuple[int, ...]], step: int = 1):
    """Edges and closing grams, and the part they belong to; with ``step``, only some, for a sample."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, left in _walks(batches, seed, short.value):
            for first in range(0, len(words), _CHUNK_WORDS):  # one text may be longer than a chunk
                columns, n = _grams_at(words, left, first, first + _CHUNK_WORDS)
                if step > 1:
                    columns, n = [column[::step] for column in columns], n[::step]
                ends = [_place(columns, bound) for bound in bounds]
                part = np.searchsorted(np.array(ends, np.int64), np.arange(len(n)), "right")
                yield from _batches([*columns, n, part], [*_GRAM, "n", "part"])

    return make


def _place(columns: list[np.ndarray], bound: tuple[int, ...]) -> int:
    """How many of the sorted rows come before ``bound``."""
    low, high = 0, len(columns[0])
    for column, value in zip(columns, bound, strict=True):
        part = column[low:high]
        low, high = low + int(np.searchsorted(part, value)), low + int(np.searchsorted(part, value, "right"))
    return low


def _bounds(docs: DataFrame, seed: int, short, parts: int) -> list[tuple[int, ...]]:
    """First grams of the parts but the first: quantiles of a bounded sample. They only decide how even
    the parts are."""
    share = _SAMPLE_TEXTS / max(docs.count(), 1)
    some = docs.sample(share, seed=1) if share < 1 else docs
    edges = some.mapInArrow(_make_edges(seed, short, [], _SAMPLE_STEP), f"{_EDGES}, part bigint")
    table = edges.select(*_GRAM).limit(parts * 10_000).toArrow()
    rows = sorted(zip(*(table[g].to_pylist() for g in _GRAM), strict=True))
    return sorted({rows[len(rows) * n // parts] for n in range(1, parts)}) if rows else []


def _flows(least: int):
    """Counts of all grams of 1 to 5 words from sorted edges: sums over rows with a common beginning.

    A sum is told if it reaches ``least``, or if it is the first or the last of its length in the
    partition, as its other part may be in the neighbouring one.
    """

    def flows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list = [None] * MOST_WORDS  # the last beginning of each length, its sum, whether it is the first
        for batch in batches:
            rows = np.column_stack([batch.column(g).to_numpy() for g in _GRAM])
            n = batch.column("n").to_numpy()
            for words in range(1, MOST_WORDS + 1):
                whole = rows[:, words - 1] != 0
                begin, count = rows[whole, :words], n[whole]
                if not len(begin):
                    continue
                first = np.flatnonzero(np.concatenate(([True], (begin[1:] != begin[:-1]).any(axis=1))))
                sums, begin = np.add.reduceat(count, first), begin[first]
                tell = sums >= least
                last = open_[words - 1]
                edge = last is None
                if last is not None:
                    if (begin[0] == last[0]).all():
                        sums[0] += last[1]
                        tell[0], edge = sums[0] >= least or last[2], last[2]
                    elif last[1] >= least or last[2]:
                        yield from _told(last[0][None, :], np.array([last[1]]))
                else:
                    tell[0] = True
                open_[words - 1] = (begin[-1].copy(), int(sums[-1]), edge and len(begin) == 1)
                tell[-1] = False
                yield from _told(begin[tell], sums[tell])
        for last in open_:
            if last is not None:
                yield from _told(last[0][None, :], np.array([last[1]]))

    return flows


def _told(begin: np.ndarray, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(sums):
        padded = np.zeros((len(sums), MOST_WORDS), np.int64)
        padded[:, : begin.shape[1]] = begin
        yield from _batches([*padded.T, sums], [*_GRAM, "n"])


def gram_counts(docs: DataFrame, least: int, seed: int, short: dict[int, int]) -> DataFrame:
    """(g1..g5, n): all grams of 1 to 5 words with at least ``least`` occurrences, words as numbers and 0
    where a gram has ended. ``docs`` has the columns lang and text."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(short)
    bounds = _bounds(docs, seed, shared, int(spark.conf.get("spark.sql.shuffle.partitions")))
    edges = docs.mapInArrow(_make_edges(seed, shared, bounds), f"{_EDGES}, part bigint")
    ordered = edges.repartitionById(len(bounds) + 1, F.col("part").cast("int")).drop("part").sortWithinPartitions(*_GRAM)
    counts = ordered.mapInArrow(_flows(least), _EDGES).groupBy(*_GRAM).agg(F.sum("n").alias("n"))
    return stored(counts.filter(F.col("n") >= least), "grams")


def _vocabulary(docs: DataFrame, n_short: int) -> tuple[DataFrame, int, dict[int, int]]:
    """(lang, word, n, hash) for all words, under the first seed that gives every word a hash of its own,
    none of them as small as the numbers of the ``n_short`` most frequent words; and those numbers."""
    counted = docs.mapInArrow(_count_words, _VOCABULARY).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counted, seed = stored(counted, "words"), 0
    while True:
        words = stored(counted.mapInArrow(_hash_words(seed), _HASHED), "vocabulary")
        shared = words.groupBy("hash").count().filter(f"count > 1 or hash between 0 and {n_short}")
        if not shared.limit(1).count():
            break
        seed += 1
    most = words.orderBy(F.desc("n"), "hash").limit(n_short).select("hash").toArrow()["hash"].to_pylist()
    return words, seed, {value: number for number, value in enumerate(most, 1)}


# -- collocations ------------------------------------------------------------------------------


def _part(first: int, last: int, names: list[str] = _GRAM) -> list:
    """Words ``first`` up to ``last`` as a gram of its own."""
    held = [F.col(g) for g in names[first:last]]
    return [c.alias(g) for c, g in zip([*held, *[F.lit(0).cast("bigint")] * (MOST_WORDS - len(held))], _GRAM, strict=True)]


def _of_size(grams: DataFrame, words: int) -> DataFrame:
    out = grams.filter(F.col(_GRAM[words - 1]) != 0)
    return out if words == MOST_WORDS else out.filter(F.col(_GRAM[words]) == 0)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def compacted(grams: DataFrame) -> DataFrame:
    """Grams of two words or more without those whose whole flow runs along one longer gram.

    A gram inside a longer one of the same count is also inside one that is longer by a single word
    and has this count, as counts never grow with length; so edges on both sides are all to look at.
    """
    inside = [
        _of_size(grams, words).select(*_part(first, first + words - 1), "n")
        for words in range(3, MOST_WORDS + 1)
        for first in (0, 1)
    ]
    phrases = grams.filter(F.col("g2") != 0)
    return phrases.join(_union(inside).distinct(), [*_GRAM, "n"], "left_anti")


def _scored(phrases: DataFrame, grams: DataFrame, totals: DataFrame) -> DataFrame:
    """The lowest-scoring cut of every phrase, ties to the earliest: lang, a, l, r, n, score. ``totals`` has
    (hash, lang, total) for all frequent words. Whole numbers of up to 38 digits keep the score exact."""
    cuts = []
    for words in range(2, MOST_WORDS + 1):
        sized = _of_size(phrases, words)
        for cut in range(1, words):
            left, right = F.struct(*_part(0, cut)).alias("left"), F.struct(*_part(cut, words)).alias("right")
            cuts.append(sized.select(*_GRAM, F.col("n").alias("a"), F.lit(cut).alias("cut"), left, right))
    sides = grams.select(F.struct(*_GRAM).alias("side"), F.col("n").alias("found"))
    known = (
        _union(cuts)
        .join(sides.select(F.col("side").alias("left"), F.col("found").alias("l")), "left")
        .join(sides.select(F.col("side").alias("right"), F.col("found").alias("r")), "right")
        .join(totals, F.col("g1") == F.col("hash"))
        .withColumns({f"_{name}": F.col(name).cast("decimal(18,0)") for name in ("a", "l", "r", "total")})
        .withColumn("score", F.expr("(1000 * _a * _total) div (_l * _r)"))
    )
    best = F.min(F.struct("score", "cut", "l", "r")).alias("best")
    return known.groupBy(*_GRAM, "lang", "a", F.col("total").alias("n")).agg(best).select(*_GRAM, "lang", "a", "best.l", "best.r", "n", "best.score")


def _spelled(phrases: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Add ``phrase``, the words with one space between."""
    words = phrases.select(*_GRAM, F.posexplode(F.filter(F.array(*_GRAM), lambda h: h != 0)).alias("place", "hash"))
    named = words.join(vocabulary.select("hash", "word"), "hash").groupBy(*_GRAM)
    told = named.agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("words"))
    return phrases.join(told.select(*_GRAM, F.array_join("words.word", " ").alias("phrase")), _GRAM)


def _best(phrases: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of every language, with their rank; parts of a language are cut down first."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = Window.partitionBy("lang", "part").orderBy(*order)
    some = phrases.withColumn("part", F.pmod(F.xxhash64(*_GRAM), F.lit(64)))
    some = some.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.filter(F.col("rank") <= top)


def collocations(
    docs: DataFrame,
    least: int = 100,
    top: int = 2000,
    text: str = "text",
    lang: str = "lang",
    short: int = _SHORT,
) -> DataFrame:
    """The ``top`` phrases of 2 to 5 words of every language by score: lang, rank, phrase, a, l, r, n, score.

    A-Z are lowered; pieces end at ``.,;:!?`` and line ends, words at spaces and tabs. n counts all words
    of the language, a the occurrences of the phrase, at least ``least``, overlaps included. Cut in two,
    the parts occur l and r times, and the score is the whole part of 1000 a n / (l r); the cut with the
    lowest score counts, ties to the earliest. A phrase inside a longer one of the same count is left out.
    Ties in rank go to the larger a, then to the phrase in byte order.

    A null language is ``und``; null, empty and blank texts have no words; repeated rows count each; an
    empty table gives no rows; other columns take no part. ``short`` is how many words get small numbers;
    it never changes the result.
    """
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    vocabulary, seed, numbers = _vocabulary(texts, short)
    grams = gram_counts(texts, least, seed, numbers)
    totals = vocabulary.groupBy("lang").agg(F.sum("n").alias("total"))
    # at most ``short`` rows of two numbers
    known = F.broadcast(docs.sparkSession.createDataFrame(list(numbers.items()), "hash bigint, number bigint"))
    frequent = vocabulary.filter(F.col("n") >= least).join(known, "hash", "left")
    frequent = frequent.select("lang", "word", F.coalesce("number", "hash").alias("hash"))
    scored = stored(_scored(compacted(grams), grams, frequent.join(totals, "lang").select("hash", "lang", "total")), "scored")
    best = _best(_spelled(scored, frequent), top)
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
