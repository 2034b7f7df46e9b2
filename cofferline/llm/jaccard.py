"""N-gram Jaccard join with prefix trees.

Every text becomes the set of its word n-grams, as 64-bit hashes. All sets share one global order:
n-grams that many texts hold come last, the others by hash. Two sets that are similar enough must
share one of their first few n-grams in this order, so only these are shuffled. Texts that meet
there, and whose parity bitmaps do not rule a link out, form candidate clusters; each cluster's sets
are stored in a trie, and every set walks the trie once: partial overlaps are shared along common
beginnings, and subtrees that cannot reach the needed overlap with what remains are left out. The
result is exact; the order and the bitmaps only decide how much work it takes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cofferline.llm.common import smallest_reachable, stored, values_of

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_MEMO_LIMIT = 150_000
_BITS = 1024  # of a small set; larger sets have more, always a power of two
#: An n-gram that comes first in more sets than this counts as frequent and moves to the end of the order.
_FREQUENT = 24
#: At most so many frequent n-grams are told to all tasks: 8 MB, whatever the data. The rest stay by hash.
_MOST_FREQUENT = 1 << 20
#: Groups of at most this many sets give their pairs; of larger ones only links that join them are given.
_PAIRED = 32
#: Sets of one part of a large group; each pair of parts is one task.
_GROUP_PART = 4096
#: Rows of a large group are looked up under so many keys.
_SALTS = 64
#: Hashes of one part of a cluster; larger clusters are cut into parts, and each pair of parts is one task.
_PART = 2_000_000

_SKETCH = "doc_id bigint, text_hash bigint, n bigint, digest binary, prefix array<bigint>, bits binary"
_SETS = "root bigint, node bigint, digest binary, n bigint, grams binary"


# -- sets -------------------------------------------------------------------------------------


class Shingler:
    """Distinct n-grams of whole texts as sorted hashes."""

    def __init__(self, size: int):
        self.size, self.memo = size, {}
        draw = np.random.default_rng(20)
        self.factors = draw.integers(1, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def _hashes(self, words: list[bytes]) -> np.ndarray:
        memo = self.memo
        try:
            return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
        except KeyError:
            if len(memo) > _MEMO_LIMIT:
                memo.clear()
            for word in words:
                if word not in memo:
                    memo[word] = xxhash.xxh3_64_intdigest(word)
            return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))

    def grams(self, text: str | None) -> np.ndarray:
        """Empty without words; fewer words than an n-gram are one gram together."""
        words = text.encode().translate(_LOWER).split() if text else []
        if not words:
            return np.empty(0, np.uint64)
        hashes = self._hashes(words)
        width = min(self.size, len(words))
        count = len(words) - width + 1
        mixed = np.full(count, width, np.uint64)
        for place in range(width):
            mixed += hashes[place : place + count] * self.factors[place]
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):  # fixed values of a public mixer
            mixed ^= mixed >> np.uint64(shift)
            mixed *= np.uint64(factor)
        mixed ^= mixed >> np.uint64(31)
        return np.unique(mixed)


def needed(left, right, percent: int):
    """Smallest overlap of two sets of these sizes that makes a link."""
    return -(-percent * (left + right) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def parity_bits(grams: np.ndarray) -> bytes:
    """Bit ``i`` tells whether an odd number of grams has ``i`` as its last bits. Two unlike sets differ in
    half of the bits, so there are enough of them that this exceeds what linked sets can differ in."""
    width = _BITS
    while 5 * width < 3 * len(grams):
        width *= 2
    odd = np.bincount((grams & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """Rows of bitmaps brought to a smaller width."""
    while bits.shape[1] > size:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def differences(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """How many bits differ in each pair, at the smaller width of the two."""
    sizes = np.array([[len(a), len(b)] for a, b in zip(left, right, strict=True)]).reshape(-1, 2)
    out = np.zeros(len(left), np.int64)
    for a, b in np.unique(sizes, axis=0).tolist():
        rows = np.flatnonzero((sizes[:, 0] == a) & (sizes[:, 1] == b))
        one, two = (
            folded(np.frombuffer(b"".join([side[row] for row in rows]), np.uint8).reshape(len(rows), -1), min(a, b))
            for side in (left, right)
        )
        out[rows] = np.bitwise_count(one ^ two).sum(axis=1, dtype=np.int64)
    return out


def room(left, right, differ, percent: int):
    """Whether sets of these sizes that differ in so many bits at least can overlap enough."""
    return 2 * needed(left, right, percent) <= left + right - differ


def _digest(grams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(grams.tobytes())


def _first_grams(size: int, percent: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Grams that come early by hash, with how often, summed over part of a task."""
        shingler, waiting, held = Shingler(size), [], 0

        def summed():
            names, counts = np.unique(np.concatenate(waiting), return_counts=True)
            waiting.clear()
            return pa.RecordBatch.from_pydict({"gram": pa.array(names.view(np.int64)), "n": pa.array(counts.astype(np.int64))})

        for batch in batches:
            for text in values_of(batch.column(0)):
                grams = shingler.grams(text)
                if len(grams):
                    # half as many again as are needed, since frequent ones will make room for others
                    waiting.append(grams[: 3 * prefix_length(len(grams), percent) // 2])
                    held += len(waiting[-1])
                if held > 2_000_000:
                    yield summed()
                    held = 0
        if waiting:
            yield summed()

    return count


def frequent_grams(docs: DataFrame, size: int, percent: int, most: int = _MOST_FREQUENT) -> np.ndarray:
    """Grams that come early in many sets, most frequent last; counted over all documents."""
    counts = docs.select("text").mapInArrow(_first_grams(size, percent), "gram bigint, n bigint")
    found = (
        counts.groupBy("gram")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") > _FREQUENT)
        .orderBy(F.desc("n"), "gram")
        .limit(most)
        .toArrow()
    )
    return found["gram"].to_numpy()[::-1].astype(np.int64).view(np.uint64)


class Order:
    """The global order, given the frequent grams from rarest to most frequent."""

    def __init__(self, frequent: np.ndarray):
        self.place = np.argsort(frequent, kind="stable")
        self.sorted = frequent[self.place]

    def first(self, grams: np.ndarray, count: int) -> np.ndarray:
        """The first ``count`` of the sorted grams."""
        if not len(self.sorted):
            return grams[:count]
        at = np.minimum(np.searchsorted(self.sorted, grams), len(self.sorted) - 1)
        hot = self.sorted[at] == grams
        rare = grams[~hot]
        if len(rare) >= count:
            return rare[:count]
        late = grams[hot][np.argsort(self.place[at[hot]], kind="stable")]
        return np.concatenate((rare, late[: count - len(rare)]))


def _sketcher(size: int, percent: int, shared):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, order = Shingler(size), Order(np.frombuffer(shared.value, np.uint64))
        for batch in batches:
            ids, hashes, texts = batch.columns
            for at in range(0, len(texts), 1000):
                ns, digests, firsts, ends, bits = [], [], [], [0], []
                for text in texts.slice(at, 1000).to_pylist():
                    grams = shingler.grams(text)
                    ns.append(len(grams))
                    digests.append(_digest(grams))
                    firsts.append(order.first(grams, prefix_length(len(grams), percent)) if len(grams) else grams)
                    ends.append(ends[-1] + len(firsts[-1]))
                    bits.append(parity_bits(grams))
                flat = np.concatenate(firsts).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(at, len(ns)),
                        hashes.slice(at, len(ns)),
                        pa.array(ns, pa.int64()),
                        pa.array(digests, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                        pa.array(bits, pa.binary()),
                    ],
                    names=["doc_id", "text_hash", "n", "digest", "prefix", "bits"],
                )

    return sketch


# -- candidates -------------------------------------------------------------------------------


def _pairer(percent: int):
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """From rows sorted by gram, size and set: pairs (a, b) of small groups, and rows (gram, a, n) of
        large ones. Only the last, unfinished group is carried from batch to batch, while it is small."""
        carried = [np.empty(0, np.int64)] * 3
        large = None  # the gram of an unfinished large group

        def batch_of(grams, a, b, sizes):
            return pa.RecordBatch.from_arrays([grams, pa.array(a), b, sizes], names=["gram", "a", "b", "n"])

        def pairs_of(left, right):
            differ = left != right
            low, high = np.minimum(left, right)[differ], np.maximum(left, right)[differ]
            rows = np.unique(np.stack((low, high)), axis=1)
            none = pa.nulls(rows.shape[1], pa.int64())
            return batch_of(none, rows[0], pa.array(rows[1]), none)

        def rows_of(grams, sizes, sets):
            return batch_of(pa.array(grams), sets, pa.nulls(len(sets), pa.int64()), pa.array(sizes))

        def closed(grams, sizes, sets):
            """All groups here are complete."""
            edges = np.flatnonzero(np.concatenate(([True], np.diff(grams) != 0, [True])))
            lengths = np.diff(edges)
            own = np.repeat(lengths, lengths)
            left, right = [], []
            for step in range(1, min(_PAIRED, len(grams))):
                same = grams[:-step] == grams[step:]
                if not same.any():
                    break
                fit = np.flatnonzero(same & (own[:-step] <= _PAIRED) & (100 * sizes[:-step] >= percent * sizes[step:]))
                left.append(sets[fit])
                right.append(sets[fit + step])
            if left:
                yield pairs_of(np.concatenate(left), np.concatenate(right))
            if (own > _PAIRED).any():
                yield rows_of(grams[own > _PAIRED], sizes[own > _PAIRED], sets[own > _PAIRED])

        for batch in batches:
            grams, sizes, sets = (
                np.concatenate((old, column.to_numpy())) for old, column in zip(carried, batch.columns, strict=True)
            )
            if large is not None:
                other = np.flatnonzero(grams != large)
                end = int(other[0]) if len(other) else len(grams)
                if end:
                    yield rows_of(grams[:end], sizes[:end], sets[:end])
                    grams, sizes, sets = grams[end:], sizes[end:], sets[end:]
            carried = [grams, sizes, sets]
            if not len(grams):
                continue
            large = None
            changes = np.flatnonzero(np.diff(grams))
            last = int(changes[-1]) + 1 if len(changes) else 0
            if last:
                yield from closed(grams[:last], sizes[:last], sets[:last])
            if len(grams) - last > _PAIRED:
                large = grams[last]
                yield rows_of(grams[last:], sizes[last:], sets[last:])
                last = len(grams)
            carried = [grams[last:], sizes[last:], sets[last:]]
        if len(carried[0]):
            yield from closed(*carried)

    return pairs


def _bounded(percent: int):
    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs whose bitmaps leave room for the needed overlap: each odd difference is a real one."""
        for batch in batches:
            differ = differences(batch.column(4).to_pylist(), batch.column(5).to_pylist())
            kept = pa.array(room(batch.column(2).to_numpy(), batch.column(3).to_numpy(), differ, percent))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(kept), batch.column(1).filter(kept)], names=["a", "b"])

    return bounded


def possible_links(sizes: np.ndarray, bits: list[bytes], percent: int, sides: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that join what the bitmaps allow to be linked, for sets in ascending order of size."""
    widths = np.array([len(own) for own in bits])
    tables: dict[int, tuple[int, np.ndarray]] = {}
    for width in np.unique(widths).tolist():  # larger sets have no fewer bits, so these are the last rows
        first = int(np.searchsorted(widths, width))
        parts = [
            folded(np.frombuffer(b"".join([own for own in bits[first:] if len(own) == wide]), np.uint8).reshape(-1, wide), width)
            for wide in np.unique(widths[first:]).tolist()
        ]
        tables[width] = first, np.concatenate(parts)
    label, out = np.arange(len(sizes)), []
    for row in range(1, len(sizes)):
        low = int(np.searchsorted(100 * sizes[:row], percent * sizes[row]))
        if low == row:
            continue
        first, table = tables[int(widths[low])]
        differ = np.bitwise_count(table[low - first : row - first] ^ table[row - first]).sum(axis=1, dtype=np.int64)
        fit = room(sizes[low:row], sizes[row], differ, percent)
        if sides is not None:
            fit &= sides[low:row] != sides[row]
        near = np.flatnonzero(fit) + low
        for own in np.unique(label[near]).tolist():
            if own != label[row]:
                out.append((int(near[label[near] == own][0]), row))
        joined = np.unique(np.append(label[near], label[row]))
        if len(joined) > 1:
            label[np.isin(label, joined)] = joined[0]
    return out


def _group(percent: int):
    def links(table: pa.Table) -> pa.Table:
        order = np.lexsort((table["a"].to_numpy(), table["n"].to_numpy()))
        sets, sizes, bits = table["a"].to_numpy()[order], table["n"].to_numpy()[order], table["bits"].to_pylist()
        sides = table["part"].to_numpy()[order] if table["i"][0].as_py() != table["j"][0].as_py() else None
        found = possible_links(sizes, [bits[row] for row in order], percent, sides)
        return pa.table({name: pa.array(sets[[link[k] for link in found]], pa.int64()) for k, name in enumerate("ab")})

    return links


def _candidates(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that join all sets between which a link is possible."""
    first = sets.select(F.explode("prefix").alias("gram"), "n", "node")
    met = first.repartition("gram").sortWithinPartitions("gram", "n", "node")
    met = stored(met.mapInArrow(_pairer(percent), "gram bigint, a bigint, b bigint, n bigint"), "met")
    known = sets.select("node", "n", "bits")
    pairs = (
        met.filter("b is not null")
        .select("a", "b")
        .distinct()
        .join(known.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a")), "a")
        .join(known.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b")), "b")
        .select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
        .mapInArrow(_bounded(percent), "a bigint, b bigint")
    )
    large = met.filter("b is null").select("gram", "a", "n")
    parts = large.groupBy("gram").agg(F.ceil(F.count("*") / _GROUP_PART).cast("int").alias("parts"))
    # only groups of several parts are looked up, and by a salt, so that none goes to one task as a whole
    several = parts.filter("parts > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    large = large.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(_SALTS)).cast("int")).join(several, ["gram", "salt"], "left")
    large = large.withColumn("parts", F.coalesce("parts", F.lit(1)))
    large = large.withColumn("part", F.pmod(F.xxhash64("a", F.lit(1)), F.col("parts")).cast("int"))
    large = large.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    large = large.join(known.select(F.col("node").alias("a"), "bits"), "a").select(
        "gram", "a", "n", "part", F.least("part", "with").alias("i"), F.greatest("part", "with").alias("j"), "bits"
    )
    joined = large.groupBy("gram", "i", "j").applyInArrow(_group(percent), "a bigint, b bigint")
    return pairs.unionByName(joined)


# -- trie -------------------------------------------------------------------------------------


class Trie:
    """Sets of small numbers in ascending order, with common beginnings stored once.

    A node holds a stretch of numbers; ``below`` gives the least and largest size of a set in its
    subtree. ``links`` walks it once for a set."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        keys = [s.astype(">u4").tobytes() for s in sets]
        order = sorted(range(len(sets)), key=keys.__getitem__)
        self.start, self.stop, self.source, self.children, self.ends = [], [], [], [], []
        self.least, self.most = [], []
        path = [self._node(0, 0, order[0])]  # nodes from the root to the last set
        previous = None
        for number in order:
            own, shared = sets[number], 0
            if previous is not None:
                width = min(len(own), len(sets[previous]))
                differ = np.flatnonzero(own[:width] != sets[previous][:width])
                shared = int(differ[0]) if len(differ) else width
            while self.start[path[-1]] >= shared and len(path) > 1:
                path.pop()
            top = path[-1]
            if self.stop[top] > shared:  # split: the part behind the shared beginning becomes a child
                child = self._node(shared, self.stop[top], self.source[top])
                self.children[child], self.ends[child] = self.children[top], self.ends[top]
                self.children[top], self.ends[top], self.stop[top] = [child], [], shared
            if len(own) > shared:
                node = self._node(shared, len(own), number)
                self.children[top].append(node)
                path.append(node)
                self.ends[node].append(number)
            else:
                self.ends[top].append(number)
            previous = number
        for node in reversed(self._preorder()):
            sizes = [len(sets[number]) for number in self.ends[node]]
            self.least[node] = min([*sizes, *(self.least[c] for c in self.children[node])])
            self.most[node] = max([*sizes, *(self.most[c] for c in self.children[node])])

    def _node(self, start: int, stop: int, source: int) -> int:
        for values, value in ((self.start, start), (self.stop, stop), (self.source, source), (self.least, 0), (self.most, 0)):
            values.append(value)
        self.children.append([])
        self.ends.append([])
        return len(self.start) - 1

    def _preorder(self) -> list[int]:
        out, stack = [], [0]
        while stack:
            node = stack.pop()
            out.append(node)
            stack.extend(self.children[node])
        return out

    def links(self, number: int, member: np.ndarray, percent: int, skip) -> Iterator[int]:
        """Sets with a larger number that overlap enough with set ``number``; ``member`` marks its elements."""
        own = self.sets[number]
        size, stack = len(own), [(0, 0)]
        while stack:
            node, overlap = stack.pop()
            if 100 * self.most[node] < percent * size or percent * self.least[node] > 100 * size:
                continue
            start, stop = self.start[node], self.stop[node]
            if stop > start:
                stretch = self.sets[self.source[node]][start:stop]
                overlap += int(np.count_nonzero(member[stretch]))
                mine = size - int(np.searchsorted(own, stretch[-1], "right"))
            else:
                mine = size
            least = max(self.least[node], -(-percent * size // 100))
            if overlap + min(mine, self.most[node] - stop) < needed(size, least, percent):
                continue
            for other in self.ends[node]:
                if other > number and overlap >= needed(size, len(self.sets[other]), percent) and not skip(other):
                    yield other
            stack.extend((child, overlap) for child in self.children[node])


def linked_sets(
    grams: list[np.ndarray], percent: int, sides: np.ndarray | None = None, weights: np.ndarray | None = None
) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links that join the sets to their components, and for every set the weights of all sets it links with.

    With ``sides`` only links between different sides are sought. Without ``weights`` the walk leaves
    out sets that are joined already, and the sums stay 0; with them it finds every link, and links
    are summed and not kept, as there may be a square of them."""
    flat = np.concatenate(grams)
    _, names, counts = np.unique(flat, return_inverse=True, return_counts=True)
    # shared grams first, so that common beginnings are long
    ranks = np.empty(len(counts), np.int64)
    ranks[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
    ends = np.cumsum([len(g) for g in grams])
    sets = [np.sort(part) for part in np.split(ranks[names], ends[:-1])]
    trie, member = Trie(sets), np.zeros(len(counts), bool)
    parent, left = list(range(len(sets))), len(sets)
    totals = np.zeros(len(sets), np.int64)

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for number in range(len(sets)):
        if left == 1 and weights is None:
            break
        member[sets[number]] = True

        def skip(other: int, number: int = number) -> bool:
            if sides is not None and sides[other] == sides[number]:
                return True
            return weights is None and root(other) == root(number)

        for other in trie.links(number, member, percent, skip):
            if weights is not None:
                totals[number] += weights[other]
                totals[other] += weights[number]
            if root(other) != root(number):
                out.append((number, other))
                parent[root(other)] = root(number)
                left -= 1
        member[sets[number]] = False
    return out, totals


def _cluster(percent: int, counted: bool = False):
    def links(table: pa.Table) -> pa.Table:
        roots, nodes = table["root"].to_numpy(), table["node"].to_numpy()
        parts, wanted, other = table["part"].to_numpy(), table["i"].to_numpy(), table["j"].to_numpy()
        copies = table["copies"].to_numpy() if counted else None
        order = np.lexsort((nodes, roots))
        # repeated rows of one set
        order = order[np.concatenate(([True], np.diff(nodes[order]) != 0))] if len(order) else order
        edges = np.flatnonzero(np.concatenate(([True], np.diff(roots[order]) != 0, [True])))
        grams = table["grams"].to_pylist()
        a, b, names, totals = [], [], [], []
        for start, end in zip(edges[:-1], edges[1:], strict=True):
            rows = order[start:end]
            if len(rows) < 2:
                continue
            sets = [np.frombuffer(grams[row], np.uint64) for row in rows]
            sides = parts[rows] if wanted[rows[0]] != other[rows[0]] else None
            found, sums = linked_sets(sets, percent, sides, copies[rows] if counted else None)
            if counted:
                names += nodes[rows].tolist()
                totals += sums.tolist()
            a += [int(nodes[rows[x]]) for x, _ in found]
            b += [int(nodes[rows[y]]) for _, y in found]
        if not counted:
            return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
        columns = (a + [None] * len(names), b + [None] * len(names), [None] * len(a) + names, [None] * len(a) + totals)
        return pa.table([pa.array(own, pa.int64()) for own in columns], names=["a", "b", "node", "n_links"])

    return links


def _gatherer(size: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in batches:
            texts = batch.column(2)
            for at in range(0, len(texts), 1000):
                grams = [shingler.grams(text) for text in texts.slice(at, 1000).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(grams)),
                        batch.column(1).slice(at, len(grams)),
                        pa.array([_digest(g) for g in grams], pa.binary()),
                        pa.array([len(g) for g in grams], pa.int64()),
                        pa.array([g.tobytes() for g in grams], pa.binary()),
                    ],
                    names=["root", "node", "digest", "n", "grams"],
                )

    return sets


# -- join -------------------------------------------------------------------------------------


def _text_hash(text: str):
    return F.xxhash64(F.col(text))


def _components(docs: DataFrame, shingle: int, percent: int, doc_id: str, text: str, counted: bool) -> DataFrame:
    """Per row doc_id, text_hash, n, component (a number, null for rows that link with nothing),
    component_id and, with ``counted``, n_links."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), _text_hash(text).alias("text_hash"), F.col(text).alias("text"))
    frequent = frequent_grams(rows, shingle, percent)
    shared = spark.sparkContext.broadcast(frequent.tobytes())
    sketch = stored(rows.mapInArrow(_sketcher(shingle, percent, shared), _SKETCH), "sketch")
    usable = sketch.filter("n > 0 and doc_id is not null")
    sets = usable.groupBy("digest").agg(
        F.min("doc_id").alias("rep"),
        F.min_by("text_hash", "doc_id").alias("rep_hash"),
        F.first("n").alias("n"),
        F.first("prefix").alias("prefix"),
        F.first("bits").alias("bits"),
    )
    if counted:
        copies = usable.select("digest", "doc_id", "text_hash").distinct().groupBy("digest").agg(F.count("*").alias("copies"))
        sets = sets.join(copies, "digest")
    # sets are numbered in a stored table: an id may have several texts, so it cannot stand for a set
    sets = stored(sets.withColumn("node", F.monotonically_increasing_id()), "sets")
    clusters = smallest_reachable(_candidates(sets, percent), "a", "b")
    clusters = stored(clusters, "clusters")
    links = _links_in_clusters(rows, sets, clusters, shingle, percent, counted)
    found = smallest_reachable(links, "a", "b")
    named = sets.join(found, "node", "left").withColumn("component", F.coalesce("root", "node"))
    named = stored(named.select("digest", "node", "rep", "component", *["copies"] * counted), "named")
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    component = named.join(least, "component").select("digest", "component", "component_id")
    more = []
    if counted:
        sums = links.filter("node is not null").groupBy("node").agg(F.sum("n_links").alias("others"))
        own = named.join(sums, "node", "left")
        own = own.select("digest", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links"))
        component = component.join(own, "digest")
        usable_row = (F.col("n") > 0) & F.col("doc_id").isNotNull()
        more = [F.when(usable_row, F.col("links")).otherwise(F.lit(0)).alias("n_links")]
    linked = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    return sketch.select("doc_id", "text_hash", "n", "digest").join(component, "digest", "left").select(
        "doc_id",
        "text_hash",
        "n",
        F.when(linked, F.col("component")).alias("component"),
        F.when(linked, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        *more,
    )


def jaccard_components(
    docs: DataFrame, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text", counted: bool = False
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles (size of its set) and component_id, the smallest doc_id
    that links reach from it, itself included.

    Two rows link when their sets of ``shingle``-word n-grams have a Jaccard similarity of at
    least ``percent`` hundredths. Texts with fewer words are one n-gram; null and empty texts, and
    texts of white space, have an empty set and link with nothing. Every text stands for itself: rows
    that share a doc_id link by their texts alone, each has its own component. Rows without a doc_id
    link with nothing and get a null component. Exact copies are one set from the start, so groups of
    them cost nothing. An empty table gives no rows.

    With ``counted`` also n_links, the number of other texts that link with the row's: distinct pairs of
    doc_id and text, so rows that are repeated as a whole count once. No link is skipped.
    """
    found = _components(docs, shingle, percent, doc_id, text, counted)
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id", *["n_links"] * counted)


def drop_near_copies(docs: DataFrame, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of every group of linked rows: the smallest doc_id's, of its texts the one with the
    smallest hash. Rows that link with nothing stay, those without a doc_id or words among them; of
    rows with the same id and text one stays. All columns are kept as they are."""
    found = _components(docs, shingle, percent, doc_id, text, False)
    chosen = found.filter("component is not null").groupBy("component").agg(F.min(F.struct("doc_id", "text_hash")).alias("kept"))
    kept = chosen.select(F.col("kept.doc_id").alias("_kept_id"), F.col("kept.text_hash").alias("_kept_hash"))
    key, hashed = F.col(doc_id).cast("bigint"), _text_hash(text)
    free = found.filter("component is null and doc_id is not null").select(F.col("doc_id").alias("_kept_id"), F.col("text_hash").alias("_kept_hash"))
    kept = kept.unionByName(free.distinct())
    named = docs.filter(key.isNotNull()).withColumns({"_key": key, "_hash": hashed})
    one = named.join(kept, (F.col("_key") == F.col("_kept_id")) & (F.col("_hash") == F.col("_kept_hash")), "left_semi")
    return one.dropDuplicates(["_key", "_hash"]).select(docs.columns).unionByName(docs.filter(key.isNull()))


def _links_in_clusters(rows: DataFrame, sets: DataFrame, clusters: DataFrame, shingle: int, percent: int, counted: bool) -> DataFrame:
    """Links within candidate clusters, and with ``counted`` rows of (node, n_links) as well. The sets are
    made again from the texts, as few are needed."""
    reps = clusters.join(sets.select("node", "rep", "rep_hash"), "node")
    members = reps.select(F.col("rep").alias("doc_id"), F.col("rep_hash").alias("text_hash"), "node", "root")
    texts = rows.join(members, ["doc_id", "text_hash"]).select("root", "node", "text")
    grams = texts.mapInArrow(_gatherer(shingle), _SETS).drop("n")
    more = ["copies"] * counted
    # two texts of one id whose hashes clash are told apart by the set
    grams = grams.join(sets.select("node", "digest", *more), ["node", "digest"])
    totals = clusters.join(sets.select("node", "n"), "node").groupBy("root").agg(F.sum("n").alias("total"))
    totals = stored(totals.withColumn("parts", F.ceil(F.col("total") / _PART).cast("int")), "totals")
    whole = totals.filter("parts = 1").agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    bins = max(1, -(-2 * whole // _PART))
    placed = grams.join(totals.select("root", "parts"), "root")
    placed = placed.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    # small clusters share a task; of a large one each pair of parts is a task
    placed = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    placed = placed.withColumn(
        "bin", F.when(F.col("parts") == 1, F.pmod(F.xxhash64("root"), F.lit(bins))).otherwise(-1 - F.col("root"))
    )
    placed = placed.select(
        "bin", "root", "node", "part", F.least("part", "with").alias("i"), F.greatest("part", "with").alias("j"), "grams", *more
    )
    columns = "a bigint, b bigint" + ", node bigint, n_links bigint" * counted
    return stored(placed.groupBy("bin", "i", "j").applyInArrow(_cluster(percent, counted), columns), "links")
