"""Benchmark decontamination with an FM-index over each shard of the training texts.

A shard is a run of documents within one task. Its words become numbers of the benchmark's
vocabulary; stretches that no benchmark phrase can touch (foreign words, and runs shorter than the
shortest phrase) shrink to one separator. The rest is indexed: suffix order by prefix doubling,
Burrows-Wheeler column in a wavelet matrix, suffix positions sampled. All phrases are searched
backwards together, their occurrences located by walking to a sampled position, and the covered
words merged into removal spans.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WORD = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")
_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_SHARD_WORDS = 1_000_000
_SAMPLED = 8
_PART_BYTES = 16_000_000

RESULT = "struct<n_words:bigint,n_hit:bigint,items:array<bigint>,spans:array<struct<start:int,end:int>>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_ARROW = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.int64())), ("spans", _SPANS)])


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words: runs of ASCII letters and digits and of all characters beyond ASCII."""
    return text.encode().translate(_TO_WORDS).split() if text else []


class Phrases:
    """The distinct windows of some benchmark items, as rows of word numbers from 1."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set] = {}
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                owners.setdefault(tuple(ids[at : at + window]), set()).add(item_id)
        self.lengths = np.array([len(p) for p in owners], np.int64)
        self.table = np.zeros((len(owners), window), np.int64)
        for row, phrase in enumerate(owners):
            self.table[row, : len(phrase)] = phrase
        held = [sorted(x for x in ids if x is not None) for ids in owners.values()]
        self.items = np.array([x for ids in held for x in ids], np.int64)
        self.item_ends = np.concatenate(([0], np.cumsum([len(ids) for ids in held]))).astype(np.int64)
        self.shortest = int(self.lengths.min()) if len(owners) else 0

    @classmethod
    def of(cls, state: dict) -> Phrases:
        """From ``vars()`` of another, the form in which phrases travel."""
        phrases = cls([], 1)
        vars(phrases).update(state)
        return phrases


class FMIndex:
    """Backward search and location of phrases in ``symbols``, where 0 separates."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        n = self.n = len(symbols)
        self.symbols, self.alphabet = symbols, alphabet
        order = self._suffix_order(symbols)
        last = symbols[order - 1]  # the first suffix is preceded by the last symbol, a separator
        self.counts = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=alphabet))))
        self.levels, self.zeros, current = [], [], last.copy()
        for bit in reversed(range(max(1, int(alphabet - 1).bit_length()))):
            ones = (current >> bit) & 1
            self.levels.append((bit, np.concatenate(([0], np.cumsum(ones, dtype=np.int32))).astype(np.int32)))
            self.zeros.append(n - int(ones.sum()))
            current = np.concatenate((current[ones == 0], current[ones == 1]))
        self.last = last
        # sampled suffix positions: every few symbols, and after each separator, where no walk may pass
        start = np.ones(n, bool)
        start[1:] = symbols[:-1] == 0
        self.sample = np.where(start[order] | (order % _SAMPLED == 0), order, -1)

    @staticmethod
    def _suffix_order(symbols: np.ndarray) -> np.ndarray:
        """Order of all suffixes; separators differ from each other by place, so none reaches past one."""
        n = len(symbols)
        separators = symbols == 0
        rank = np.where(separators, np.cumsum(separators) - 1, symbols + int(separators.sum()))
        step = 1
        while True:
            after = np.zeros(n, np.int64)
            after[:-step] = rank[step:] + 1
            key = rank * (int(after.max()) + 1) + after
            order = np.argsort(key, kind="stable")
            fresh = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
            rank = np.empty(n, np.int64)
            rank[order] = fresh
            step *= 2
            if fresh[-1] == n - 1 or step >= n:
                return order

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place of the last column."""
        low, high = np.zeros_like(place), place.copy()
        for (bit, ones), zeros in zip(self.levels, self.zeros, strict=True):
            up = ((symbol >> bit) & 1).astype(bool)
            low = np.where(up, zeros + ones[low], low - ones[low])
            high = np.where(up, zeros + ones[high], high - ones[high])
        return high - low

    def search(self, table: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end row of every phrase in the suffix order."""
        low, high = np.zeros(len(table), np.int64), np.full(len(table), self.n, np.int64)
        for step in range(int(lengths.max())):
            live = np.flatnonzero((lengths > step) & (low < high))
            if not len(live):
                break
            symbol = table[live, lengths[live] - 1 - step]
            base = self.counts[symbol]
            low[live] = base + self.rank(symbol, low[live])
            high[live] = base + self.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows of the suffix order."""
        place, walked, rows = np.empty(len(rows), np.int64), 0, rows.copy()
        open_ = np.arange(len(rows))
        while len(open_):
            found = self.sample[rows]
            done = found >= 0
            place[open_[done]] = found[done] + walked
            open_, rows = open_[~done], rows[~done]
            symbol = self.last[rows]
            rows = self.counts[symbol] + self.rank(symbol, rows)
            walked += 1
        return place


def _kept(ids: np.ndarray, shortest: int) -> np.ndarray:
    """Places of the words in runs of known words that are long enough for a phrase."""
    known = np.concatenate(([0], (ids > 0).view(np.int8), [0]))
    edges = np.flatnonzero(np.diff(known))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= shortest
    starts, sizes = starts[long], (ends - starts)[long]
    return np.repeat(starts - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(int(sizes.sum())) if len(starts) else starts


def shard_hits(docs: list[list[bytes]], phrases: Phrases) -> dict[int, tuple[list, set]]:
    """For each document with occurrences: covered word spans in order, and the items found."""
    symbols, owner, place = [], [], []
    get = phrases.vocabulary.get
    for row, words in enumerate(docs):
        ids = np.frombuffer(array("i", map(get, words, repeat(0))), np.int32) if words else np.empty(0, np.int32)
        kept = _kept(ids, phrases.shortest)
        if len(kept):
            # one separator after every run
            breaks = np.append(np.flatnonzero(np.diff(kept) > 1) + 1, len(kept))
            symbols.append(np.insert(ids[kept].astype(np.int64), breaks, 0))
            place.append(np.insert(kept, breaks, -1))
            owner.append(np.full(len(symbols[-1]), row))
    if not symbols:
        return {}
    symbols, owner, place = map(np.concatenate, (symbols, owner, place))
    index = FMIndex(symbols, len(phrases.vocabulary) + 1)
    low, high = index.search(phrases.table, phrases.lengths)
    sizes = np.maximum(high - low, 0)
    if not sizes.sum():
        return {}
    which = np.repeat(np.arange(len(sizes)), sizes)
    rows = np.arange(int(sizes.sum())) + np.repeat(low - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
    found = index.locate(rows)
    change = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(change, found, 1)
    np.add.at(change, found + phrases.lengths[which], -1)
    covered = np.concatenate(([0], (np.cumsum(change[:-1]) > 0).view(np.int8), [0]))
    edges = np.flatnonzero(np.diff(covered))
    hits: dict[int, tuple[list, set]] = {}
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        spans, _ = hits.setdefault(int(owner[start]), ([], set()))
        spans.append((int(place[start]), int(place[end - 1]) + 1))
    for row, phrase in np.unique(np.stack((owner[found], which)), axis=1).T.tolist():
        hits[row][1].update(phrases.items[phrases.item_ends[phrase] : phrases.item_ends[phrase + 1]].tolist())
    return hits


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _text_spans(text: str, spans: list[tuple[int, int]]) -> list[dict]:
    places = [m.span() for m in _WORD.finditer(text)]
    return [{"start": places[a][0], "end": places[b - 1][1]} for a, b in spans]


def judge_texts(texts: list[str | None], parts: list[Phrases]) -> list[dict]:
    """Result rows for the documents of one batch, shard by shard."""
    out: list[dict] = []
    shard: list[list[bytes]] = []

    def flush():
        first, found = len(out), {}
        for phrases in parts:
            if len(phrases.lengths):
                for row, (spans, items) in shard_hits(shard, phrases).items():
                    own = found.setdefault(row, ([], set()))
                    own[0].extend(spans)
                    own[1].update(items)
        for row, words in enumerate(shard):
            spans, items = found.get(row, ([], set()))
            spans = _merged(spans)
            hit = sum(b - a for a, b in spans)
            places = _text_spans(texts[first + row], spans) if spans else []
            out.append({"n_words": len(words), "n_hit": hit, "items": sorted(items), "spans": places})
        shard.clear()

    held = 0
    for text in texts:
        words = words_of(text)
        if held and held + len(words) > _SHARD_WORDS:
            flush()
            held = 0
        shard.append(words)
        held += len(words)
    flush()
    return out


def _judge(parts: list):
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        phrases = [Phrases.of(part.value) for part in parts]
        for texts in batches:
            yield pa.array(judge_texts(texts.to_pylist(), phrases), _ARROW)

    return judge


def phrase_parts(benchmark: DataFrame, window: int, item_id: str, text: str) -> list:
    """The benchmark's phrases as broadcasts, each from at most ``_PART_BYTES`` of texts or one item."""
    rows = benchmark.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(text).alias("text")).filter("text is not null")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    count = max(1, -(-2 * size // _PART_BYTES)) if size > _PART_BYTES else 1
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(count)))
    context = benchmark.sparkSession.sparkContext
    return [
        context.broadcast(vars(Phrases([(r.item_id, r.text) for r in dealt.filter(F.col("part") == part).collect()], window)))
        for part in range(count)
    ]


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 13,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    found: str = "found",
) -> DataFrame:
    """Add ``found`` to every document: n_words, n_hit (words inside any occurrence of a window),
    ``items`` (item_ids with occurrences, sorted) and ``spans`` (what to remove, in code points).

    Null and empty texts have no words. Items without words are ignored, an item_id that comes twice
    counts once, items with a null id hit words but are not listed. An empty benchmark hits nothing.
    Documents stay where they are: no shuffle. The benchmark travels in parts of bounded size, so a
    shard holds one index and the phrases at a time.
    """
    judge = F.arrow_udf(_judge(phrase_parts(benchmark, window, item_id, item_text)), RESULT)
    return docs.withColumn(found, judge(F.col(text)))


def contaminated(found: str = "found"):
    """A document with hits of at least a twentieth of its words."""
    hit, words = F.col(f"{found}.n_hit"), F.col(f"{found}.n_words")
    return (hit > 0) & (20 * hit >= words)
