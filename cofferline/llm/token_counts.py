"""Token counts that survive edits.

A document is kept as its pre-tokens and a segment tree over them: every node holds the characters
and tokens below it. An edit is found by descending on character sums. Only the touched pre-tokens
and some context are cut and counted anew, until a cut falls on one of the old boundaries; the
tree's sums are updated above the leaves that changed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cofferline.llm.bpe import PieceMemory, read_ranks, sentencepiece_model
from cofferline.llm.common import values_of

EDITS = "array<struct<start:int,end:int,text:string>>"
RESULT = "struct<before:bigint,after:bigint,edits:int,recounted:bigint,text:string>"
_ARROW = pa.struct([("before", pa.int64()), ("after", pa.int64()), ("edits", pa.int32()), ("recounted", pa.int64()), ("text", pa.string())])
_LEAF = 64  # pre-tokens in a leaf of the tree
#: Characters a pre-token can depend on beyond its own: a contraction looks two ahead, white space one.
_LOOKS_AHEAD = 3


class Leaf:
    """A run of pre-tokens with its sums."""

    __slots__ = ("pieces", "counts", "chars", "tokens")

    def __init__(self, pieces: list[str], counts: list[int]):
        self.pieces, self.counts = pieces, counts
        self.chars, self.tokens = sum(map(len, pieces)), sum(counts)


class SegmentTree:
    """Sums over leaves in an array: node ``i`` holds what ``2 i`` and ``2 i + 1`` hold."""

    def __init__(self, leaves: list[Leaf]):
        self.leaves, self.width = leaves, 1
        while self.width < max(1, len(leaves)):
            self.width *= 2
        self.sums = np.zeros((2 * self.width, 2), np.int64)
        for place, leaf in enumerate(leaves):
            self.sums[self.width + place] = leaf.chars, leaf.tokens
        level = self.width
        while level > 1:
            below = self.sums[level : 2 * level]
            self.sums[level // 2 : level] = below[::2] + below[1::2]
            level //= 2

    def total(self) -> tuple[int, int]:
        return int(self.sums[1, 0]), int(self.sums[1, 1])

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, and the leaf's first character; the last one beyond the end."""
        node, start = 1, 0
        while node < self.width:
            left = int(self.sums[2 * node, 0])
            node *= 2
            if place >= start + left and self.sums[node + 1, 0] > 0:
                start += left
                node += 1
        return node - self.width, start

    def put(self, leaf: int, content: Leaf) -> None:
        self.leaves[leaf] = content
        node = self.width + leaf
        change = np.array([content.chars, content.tokens]) - self.sums[node]
        while node:
            self.sums[node] += change
            node //= 2


class CountedText:
    """One document, its counts, and edits to it."""

    def __init__(self, text: str, find, iterate, memory: PieceMemory):
        self.find, self.iterate, self.memory, self.recounted = find, iterate, memory, 0
        pieces = find(text)
        counts = self._counts(pieces)
        self._build(pieces, counts)

    def _build(self, pieces: list[str], counts: list[int]) -> None:
        runs = range(0, len(pieces), _LEAF)
        self.tree = SegmentTree([Leaf(pieces[i : i + _LEAF], counts[i : i + _LEAF]) for i in runs] or [Leaf([], [])])

    def _counts(self, pieces: list[str]) -> list[int]:
        self.memory.learn(set(pieces))
        return [len(ids) // 4 for ids in map(self.memory.__getitem__, pieces)]

    @property
    def tokens(self) -> int:
        return self.tree.total()[1]

    def text(self) -> str:
        return "".join("".join(leaf.pieces) for leaf in self.tree.leaves)

    def edit(self, start: int, end: int, text: str) -> None:
        """Put ``text`` in place of the characters from ``start`` to ``end``; both are clipped to the text."""
        size = self.tree.total()[0]
        start = min(max(start, 0), size)
        end = min(max(end, start), size)
        first, at = self.tree.leaf_at(max(0, start - _LOOKS_AHEAD))
        # the first pre-token whose cut could see the edit
        leaf, skipped, place = self.tree.leaves[first], 0, at
        for piece in leaf.pieces:
            if place + max(len(piece), _LOOKS_AHEAD) + 2 > start:
                break
            place += len(piece)
            skipped += 1
        head, head_counts = leaf.pieces[:skipped], leaf.counts[:skipped]
        # old pre-tokens from there on, taken leaf by leaf until the new cuts meet an old boundary
        old, boundaries, taken, reach = [], {}, first, place
        pending = ""

        def take():
            nonlocal taken, reach, pending
            own = self.tree.leaves[taken]
            skip = skipped if taken == first else 0
            for piece, count in zip(own.pieces[skip:], own.counts[skip:], strict=True):
                boundaries[reach] = len(old)
                old.append((piece, count))
                reach += len(piece)
                pending += piece
            taken += 1

        take()
        while taken < len(self.tree.leaves) and reach < end + _LOOKS_AHEAD + 1:
            take()
        new, tail, more = [], None, True
        while more:
            more = False
            fresh = pending[: start - place] + text + pending[end - place :]
            shift, new, cut = len(text) - (end - start), [], place
            for found in self.iterate(fresh):
                piece = found.group()
                edge = cut - shift  # where this cut lay in the old text
                decided = found.start() + _LOOKS_AHEAD < len(fresh) or taken >= len(self.tree.leaves)
                if decided and cut >= start + len(text) and edge in boundaries and edge >= end:
                    tail = boundaries[edge]
                    break
                new.append(piece)
                cut += len(piece)
            if tail is None and taken < len(self.tree.leaves):
                take()  # no old boundary met yet, and the last pre-token may go on
                more = True
        counts = self._counts(new)
        self.recounted += len(new)
        rest = old[tail:] if tail is not None else []
        pieces = head + new + [piece for piece, _ in rest]
        sums = head_counts + counts + [count for _, count in rest]
        self._replace(first, taken, pieces, sums)

    def _replace(self, first: int, end: int, pieces: list[str], counts: list[int]) -> None:
        """New content for leaves ``first`` to ``end``; leaves that grow too long cause a new tree."""
        span = end - first
        if len(pieces) > 4 * _LEAF * span:
            leaves = self.tree.leaves
            before = [x for leaf in leaves[:first] for x in zip(leaf.pieces, leaf.counts, strict=True)]
            after = [x for leaf in leaves[end:] for x in zip(leaf.pieces, leaf.counts, strict=True)]
            both = [*before, *zip(pieces, counts, strict=True), *after]
            self._build([piece for piece, _ in both], [count for _, count in both])
            return
        size = -(-len(pieces) // span) if pieces else 0
        for place in range(span):
            run = slice(place * size, (place + 1) * size)
            self.tree.put(first + place, Leaf(pieces[run], counts[run]))


def apply_edits(document: CountedText, edits: list[dict] | None) -> int:
    """Edits are given in places of the original text; overlapping ones after the first are left out.
    They are made from the back, so that earlier places stay what they were."""
    chosen, reached = [], 0
    ordered = sorted(
        (max(e["start"], 0), max(e["end"], e["start"], 0), e["text"] or "")
        for e in edits or []
        if e is not None and e["start"] is not None and e["end"] is not None
    )
    for start, end, text in ordered:
        if start >= reached:
            chosen.append((start, end, text))
            reached = max(end, start)
    for start, end, text in reversed(chosen):
        document.edit(start, end, text)
    return len(chosen)


def _counter(shared, pattern: str):
    def count(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        tokens, model = shared.value
        memory, cuts = PieceMemory(model, tokens), regex.compile(pattern)
        for texts, edits in batches:
            out = []
            for text, own in zip(values_of(texts), values_of(edits), strict=True):
                document = CountedText(text or "", cuts.findall, cuts.finditer, memory)
                before = document.tokens
                made = apply_edits(document, own)
                # the text is given only where it has changed
                out.append((before, document.tokens, made, document.recounted, document.text() if made else None))
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.StructArray.from_arrays(
                [pa.array(values, field.type) for values, field in zip(columns, _ARROW, strict=True)], fields=list(_ARROW)
            )

    return count


def count_tokens(
    docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", edits: str = "edits", counted: str = "counted"
) -> DataFrame:
    """Add ``counted``: tokens before and after the edits, the number of edits made, the pre-tokens
    that were counted anew for them, and the edited text (null where nothing was edited).

    ``edits`` holds for every document (start, end, text) in code points of the original, end
    exclusive; null edits, and edits without places, are skipped; places beyond the text are clipped;
    of edits that overlap the first counts. Null and empty texts have no tokens. No shuffle.
    """
    tokens = read_ranks(ranks_path)
    shared = docs.sparkSession.sparkContext.broadcast((tokens, sentencepiece_model(tokens)))
    count = F.arrow_udf(_counter(shared, pattern), RESULT)
    return docs.withColumn(counted, count(F.col(text), F.col(edits)))
