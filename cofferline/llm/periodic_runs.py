"""Periodic runs of words by recompression.

The words of many documents stand in one row of numbers, parted by numbers that occur once. Every
round of recompression names maximal blocks of equal symbols, then pairs of a left and a right
symbol, so equal stretches are cut alike nearly everywhere and a run collapses into one block after
few rounds. The symbols of all rounds make a grammar: two equal symbols stand for equal words, which
lets the longest common extension of two places be measured by steps over whole symbols.

A run of period p and length 4p or more covers four neighbouring multiples of p. So the places of
the harmonic grid (all multiples of all periods) at which four words in a row agree are the
candidates, and two extensions, to the right and to the left, tell the exact run of a candidate.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cofferline.llm.common import values_of

RESULT = "struct<runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_CHUNK_WORDS = 400_000  # documents are taken together up to so many words, or one alone
_GRID = 4  # neighbouring grid places a run must cover
_MIX = np.uint64(0x9E3779B97F4A7C15)


# -- grammar ----------------------------------------------------------------------------------


def _block_lengths(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and length of every maximal block of equal symbols."""
    first = np.flatnonzero(np.concatenate(([True], symbols[1:] != symbols[:-1])))
    return first, np.diff(np.append(first, len(symbols)))


def _named(left: np.ndarray, right: np.ndarray, fresh: int) -> np.ndarray:
    """Numbers from ``fresh`` on, equal for equal pairs only; both sides are below 2**32."""
    _, names = np.unique(left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64), return_inverse=True)
    return names.astype(np.int64) + fresh


def _side(symbols: np.ndarray, turn: int) -> np.ndarray:
    """A side, left or right, for every symbol; another choice every round."""
    mixed = (symbols.astype(np.uint64) + np.uint64(turn + 1)) * _MIX
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * _MIX) >> np.uint64(63)).astype(bool)


class Grammar:
    """All rounds over ``words``, whose entries below ``n_single`` occur once and never join others.

    The first and the last word must be such entries.
    """

    def __init__(self, words: np.ndarray, n_single: int):
        self.size = len(words)
        symbols, places = words.astype(np.int64), np.arange(self.size + 1)
        rounds, fresh, turn = [(symbols, places)], int(words.max()) + 1, 0
        while len(symbols) > 2 * n_single and turn < 64:
            first, length = _block_lengths(symbols)
            several = length > 1
            symbols, places = symbols[first], places[np.append(first, len(symbols))]
            if several.any():
                symbols[several] = _named(symbols[several], length[several], fresh)
                fresh = int(symbols.max()) + 1
            right, free = _side(symbols, turn), symbols >= n_single
            both = free[:-1] & free[1:]
            one, other = both & ~right[:-1] & right[1:], both & right[:-1] & ~right[1:]
            pair = np.flatnonzero(one if one.sum() >= other.sum() else other)
            turn += 1
            if len(pair):
                symbols[pair] = _named(symbols[pair], symbols[pair + 1], fresh)
                symbols, places = np.delete(symbols, pair + 1), np.delete(places, pair + 1)
                fresh = max(fresh, int(symbols.max()) + 1)
                rounds.append((symbols, places))
            elif not both.any():
                break
        self.forward, self.backward = self._table(rounds, True), self._table(rounds, False)

    def _table(self, rounds: list, forward: bool) -> tuple[np.ndarray, ...]:
        """Symbols that begin (or end) at every place, from the words upwards: the first entry of each
        place, their number, and for each its symbol, its length and how often it is repeated."""
        count = np.zeros(self.size + 2, np.int64)
        for _, places in rounds:
            count[places[:-1] if forward else places[1:]] += 1
        offset = np.cumsum(count) - count
        total = int(count.sum())
        symbol, length, repeats = (np.zeros(total, np.int64) for _ in range(3))
        for level, (symbols, places) in enumerate(rounds):
            at = offset[places[:-1] if forward else places[1:]] + level
            first, block = _block_lengths(symbols)
            inside = np.arange(len(symbols)) - np.repeat(first, block)
            symbol[at], length[at] = symbols, np.diff(places)
            repeats[at] = np.repeat(block, block) - inside if forward else inside + 1
        return offset, count, symbol, length, repeats

    def extension(self, left: np.ndarray, right: np.ndarray, forward: bool) -> np.ndarray:
        """Length of the common words from the places ``left`` and ``right`` on, to one side, for
        many pairs of places at once. A pair climbs while the larger symbols agree, steps over all
        repeats that both have, and descends where they differ."""
        offset, count, symbol, length, repeats = self.forward if forward else self.backward
        out = np.zeros(len(left), np.int64)
        live, level = np.arange(len(left)), np.zeros(len(left), np.int64)
        while len(live):
            step = out[live] if forward else -out[live]
            a, b = left[live] + step, right[live] + step
            top = np.minimum(count[a], count[b]) - 1
            inside = top >= 0
            level = np.minimum(level, top)
            x, y = offset[a] + level, offset[b] + level
            x[~inside] = y[~inside] = 0
            same = inside & (symbol[x] == symbol[y])
            climb = same & (level < top)
            up = np.flatnonzero(climb)
            climb[up] = symbol[x[up] + 1] == symbol[y[up] + 1]
            take = same & ~climb
            out[live[take]] += np.minimum(repeats[x[take]], repeats[y[take]]) * length[x[take]]
            level = level + climb - ~same
            keep = level >= 0
            live, level = live[keep], level[keep]
        return out


# -- runs -------------------------------------------------------------------------------------


def _grid_candidates(words: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Grid places and their periods at which this and the next three grid words agree."""
    places, periods = [], []
    for period in range(1, longest // _GRID + 1):
        on_grid = words[::period]
        same = on_grid[1:] == on_grid[:-1]
        if len(same) < 3:
            break
        found = np.flatnonzero(same[2:] & same[1:-1] & same[:-2])
        if len(found):
            places.append(found * period)
            periods.append(np.full(len(found), period))
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(periods)


def _joined(documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All documents in one row, words moved up by the number of separators, and their first places."""
    sizes = np.array([len(d) for d in documents])
    first = np.cumsum(sizes + 1) - sizes
    words = np.empty(int(sizes.sum()) + len(documents) + 1, np.int64)
    words[first - 1] = np.arange(len(documents))
    words[-1] = len(documents)
    for place, document in zip(first, documents, strict=True):
        words[place : place + len(document)] = document
    inner = np.ones(len(words), bool)
    inner[first - 1] = inner[-1] = False
    words[inner] += len(documents) + 1
    return words, first


class _Found:
    """Runs so far as (start, end, period), and whether one of them settles a candidate."""

    def __init__(self):
        self.start = self.end = self.period = np.zeros(0, np.int64)

    def add(self, start, end, period) -> None:
        start, end, period = (np.concatenate(x) for x in ((self.start, start), (self.end, end), (self.period, period)))
        order = np.lexsort((period, end, start))
        start, end, period = start[order], end[order], period[order]
        new = np.concatenate(([True], (start[1:] != start[:-1]) | (end[1:] != end[:-1])))[: len(start)]
        self.start, self.end, self.period = start[new], end[new], period[new]  # one run, its smallest period
        farthest = np.maximum.accumulate(self.end) if len(self.end) else self.end
        owner = np.where(self.end == farthest, np.arange(len(farthest)), 0)
        self.owner = np.maximum.accumulate(owner) if len(owner) else owner

    def settles(self, places, periods) -> np.ndarray:
        """Inside a run whose period divides the candidate's, so the candidate's run is that run."""
        if not len(self.start):
            return np.zeros(len(places), bool)
        row = np.searchsorted(self.start, places, "right") - 1
        run = self.owner[np.maximum(row, 0)]
        inside = (row >= 0) & (self.end[run] > places + 3 * periods)
        return inside & (periods % self.period[run] == 0)


def _runs_at(words: np.ndarray, n_single: int, places, periods, least: int) -> _Found:
    """Maximal runs of the candidates; periods are taken up by doublings, so that multiples of a
    period find its run settled."""
    grammar, found = Grammar(words, n_single), _Found()
    doubling = np.floor(np.log2(np.maximum(periods, 1))).astype(np.int64)
    order = np.lexsort((places, periods, doubling))
    places, periods, doubling = places[order], periods[order], doubling[order]
    head = np.concatenate(([True], (np.diff(periods) != 0) | (np.diff(places) != periods[1:])))[: len(places)]
    for turn in np.unique(doubling):
        for heads in (True, False):
            chosen = (doubling == turn) & (head == heads)
            at, period = places[chosen], periods[chosen]
            rest = ~found.settles(at, period)
            at, period = at[rest], period[rest]
            if len(at):
                end = at + period + grammar.extension(at, at + period, True)
                start = at - grammar.extension(at, at + period, False)
                long = end - start >= np.maximum(least, _GRID * period)
                found.add(start[long], end[long], period[long])
    return found


def runs_of(documents: list[np.ndarray], least: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Start, end and period of all runs of every document, by start, then period."""
    none = (np.zeros(0, np.int64),) * 3
    out = [none] * len(documents)
    by_size = defaultdict(list)
    for n, document in enumerate(documents):
        if len(document) >= max(least, _GRID):
            by_size[len(document).bit_length()].append(n)
    for rows in by_size.values():
        words, first = _joined([documents[n] for n in rows])
        places, periods = _grid_candidates(words, max(len(documents[n]) for n in rows))
        owner = np.searchsorted(first, places, "right") - 1
        within = np.searchsorted(first, places + (_GRID - 1) * periods, "right") - 1 == owner  # of one document
        places, periods, owner = places[within], periods[within], owner[within]
        held = np.unique(owner)
        if not len(held):
            continue
        few, few_first = _joined([documents[rows[n]] for n in held])
        names = np.unique(few, return_inverse=True)[1]  # below 2**32 in any case
        seat = np.searchsorted(held, owner)
        found = _runs_at(names, len(held) + 1, places - first[owner] + few_first[seat], periods, least)
        order = np.lexsort((found.period, found.start))
        start, end, period = found.start[order], found.end[order], found.period[order]
        bounds = np.searchsorted(start, np.append(few_first, len(few)))
        for n, row in enumerate(held):
            span = slice(bounds[n], bounds[n + 1])
            out[rows[row]] = (start[span] - few_first[n], end[span] - few_first[n], period[span])
    return out


# -- documents --------------------------------------------------------------------------------


def _collapsed(words: list[bytes], runs: tuple) -> str:
    """The words that no run repeats, joined by one space."""
    start, end, period = runs
    if len(start):
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, start + period, 1)
        np.add.at(edge, end, -1)
        words = [words[n] for n in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
    return b" ".join(words).decode()


def _chunks(texts: pa.Array) -> Iterator[list[list[bytes]]]:
    """Words of some documents at a time."""
    waiting, held = [], 0
    for text in values_of(texts):
        waiting.append(text.encode().split() if text else [])
        held += len(waiting[-1])
        if held > _CHUNK_WORDS:
            yield waiting
            waiting, held = [], 0
    if waiting:
        yield waiting


def _result(texts: pa.Array, least: int) -> pa.Array:
    sizes, parts, collapsed = [0], [], []
    for chunk in _chunks(texts):
        names: defaultdict[bytes, int] = defaultdict()
        names.default_factory = names.__len__
        numbered = [np.fromiter(map(names.__getitem__, words), np.int64, len(words)) for words in chunk]
        for words, runs in zip(chunk, runs_of(numbered, least), strict=True):
            sizes.append(sizes[-1] + len(runs[0]))
            if len(runs[0]):
                parts.append(runs)
            collapsed.append(_collapsed(words, runs))
    start, end, period = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 3
    runs = pa.StructArray.from_arrays([pa.array(start), pa.array(end - start), pa.array(period)], fields=list(_RUN))
    lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), runs)
    return pa.StructArray.from_arrays([lists, pa.array(collapsed, pa.string())], ["runs", "collapsed"])


def _finder(least: int):
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield _result(texts, least)

    return find


def find_runs(docs: DataFrame, text: str | Column = "text", least: int = 6, found: str = "found") -> DataFrame:
    """Add ``found`` to every document: ``runs`` (start, length and period in words, by start, then
    period) and ``collapsed``, the text without the repeats of any run.

    Words are parted by ASCII white space. A run is a stretch with smallest period q and at least
    ``least`` and 4q words that no neighbour extends. All runs of whole texts are told; a word goes
    if any run holds it after that run's first q words, and the kept words are joined by one space.
    Null, empty and blank texts have no runs and an empty collapsed text; repeated rows are judged
    alike; an empty table gives an empty one. ``found`` replaces a column of that name. Documents stay
    where they are: no shuffle, and a task holds some hundred thousand words or one document at a time.
    """
    column = F.col(text) if isinstance(text, str) else text
    return docs.withColumn(found, F.arrow_udf(_finder(least), RESULT)(column))


def words_of(text: Column) -> Column:
    """Words of a text as an array; none for a null text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))


def with_repeats(text: Column, words: Column, first: Column, period: Column) -> Column:
    """The text whose words from number ``first`` on repeat the ``period`` words there."""
    n = F.size(words)
    tail = F.slice(words, (first + 1).cast("int"), period.cast("int"))
    times = F.ceil((n - first) / period).cast("int")
    whole = F.concat(F.slice(words, F.lit(1), first.cast("int")), F.flatten(F.array_repeat(tail, times)))
    return F.array_join(F.slice(whole, F.lit(1), n), " ")
