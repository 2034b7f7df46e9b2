"""Toxicity by nearest labelled examples.

Terms are words and beginnings of words. Those that tell the classes apart (chi-square over the
examples) get TF-IDF weights; examples and texts are compared by the exact cosine of these vectors.
An inverted index with the largest weight of every block of examples gives an upper bound per block:
blocks are scored in falling order of it until none can hold a nearer example. The nearest ones vote
with a weight that falls with distance; a prior pulls weak evidence to the base rate.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cofferline.llm.common import values_of
from cofferline.llm.decontaminate import words_of

#: Bounds of the fit: labelled examples that are used, and terms that are kept.
MAX_EXAMPLES = 4096
MAX_TERMS = 4096
_LEAST_CHI2 = 30.0
_LEAST_EXAMPLES = 5
_STARTS = (4, 5, 6)  # lengths of word beginnings
_BLOCK = 32
_NEAREST = 25
_SHARPNESS = 4  # votes weigh cosine ** 4
_PRIOR_WEIGHT = 0.5
_EVIDENCE = 5
_MEMO_LIMIT = 150_000

RESULT = "struct<score:double,evidence:array<struct<doc_id:bigint,label:int,cosine:double>>>"
_PROOF = pa.list_(pa.struct([("doc_id", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())]))


def terms_of(word: bytes) -> list[str]:
    """A word and its beginnings; beginnings are marked so that they differ from whole words."""
    text = word.decode()
    return [text, *[f"{text[:n]}*" for n in _STARTS if len(text) > n]]


# -- fit --------------------------------------------------------------------------------------


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many examples of each class hold a term, summed over the rows of a task."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts[label].update({term for word in set(words_of(text)) for term in terms_of(word)})
    names = list(counts[0].keys() | counts[1].keys())
    for at in range(0, len(names), 50_000):
        part = names[at : at + 50_000]
        yield pa.RecordBatch.from_pydict(
            {
                "term": pa.array(part, pa.string()),
                "clean": pa.array([counts[0][t] for t in part], pa.int64()),
                "toxic": pa.array([counts[1][t] for t in part], pa.int64()),
            }
        )


def examples_of(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` labelled documents, chosen by a hash of the id: doc_id, label 0 or 1, text.

    Ids that come twice in the labels take the larger label, in the documents the smallest text."""
    ids = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("label").cast("int").alias("label"))
        .filter("doc_id is not null and label in (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    # the ids are at most ``limit``, so they may go to every task
    return texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))


class Index:
    """Examples as blocked inverted lists."""

    def __init__(self, state: dict):
        vars(self).update(state)

    @staticmethod
    def build(terms: list[tuple[str, int]], examples: list[tuple[int, int, list, list]], total: int, base: float) -> dict:
        """``terms``: (term, examples that hold it); ``examples``: (doc_id, label, term numbers, counts)."""
        idf = np.array([math.log((1 + total) / (1 + n)) + 1 for _, n in terms])
        kept = [e for e in sorted(examples, key=lambda e: e[0]) if len(e[2])]
        blocks = max(1, -(-len(kept) // _BLOCK))
        lists: list[list] = [[] for _ in terms]
        for row, (_, _, numbers, counts) in enumerate(kept):
            weights = Index.weights(np.array(numbers), np.array(counts), idf)
            for number, weight in zip(numbers, weights.tolist(), strict=True):
                lists[number].append((row, weight))
        tops = np.zeros((len(terms), blocks))
        starts = np.zeros((len(terms), blocks + 1), np.int64)
        rows, weights, place = [], [], 0
        for number, postings in enumerate(lists):
            rows += [row for row, _ in postings]
            weights += [weight for _, weight in postings]
            own = np.array([row for row, _ in postings], np.int64)
            starts[number] = place + np.searchsorted(own, np.arange(blocks + 1) * _BLOCK)
            for row, weight in postings:
                tops[number, row // _BLOCK] = max(tops[number, row // _BLOCK], weight)
            place += len(postings)
        none = [label for _, label, numbers, _ in examples if not len(numbers)]
        return {
            "names": {term: number for number, (term, _) in enumerate(terms)},
            "idf": idf,
            "tops": tops,
            "starts": starts,
            "rows": np.array(rows, np.int64),
            "values": np.array(weights),
            "ids": [e[0] for e in kept],
            "labels": np.array([e[1] for e in kept], np.float64),
            "base": base,
            # texts without any term: the rate among such examples, drawn to the base rate
            "nothing": (sum(none) + base) / (len(none) + 1),
        }

    @staticmethod
    def weights(numbers: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
        weights = (1 + np.log(counts)) * idf[numbers]
        return weights / np.sqrt((weights**2).sum())

    def nearest(self, numbers: np.ndarray, weights: np.ndarray, k: int) -> list[tuple[float, int]]:
        """The ``k`` examples of largest cosine, nearest first, ties to the smaller doc_id."""
        bounds = weights @ self.tops[numbers]
        best: list[tuple[float, int]] = []
        for block in np.argsort(-bounds, kind="stable").tolist():
            if bounds[block] <= 0 or len(best) == k and bounds[block] < -best[-1][0] - 1e-9:
                break
            scores = np.zeros(_BLOCK)
            for number, weight in zip(numbers.tolist(), weights.tolist(), strict=True):
                span = slice(self.starts[number, block], self.starts[number, block + 1])
                scores[self.rows[span] - block * _BLOCK] += weight * self.values[span]
            found = np.flatnonzero(scores > 0)
            # rounding must not order examples that are equally near
            best += [(-s, row) for s, row in zip(np.round(scores[found], 12).tolist(), (found + block * _BLOCK).tolist(), strict=True)]
            best = sorted(best)[:k]
        return [(-score, row) for score, row in best]

    def judge(self, counts: dict[int, int]) -> tuple[float, list[dict]]:
        if not counts:
            return self.nothing, []
        numbers = np.array(sorted(counts))
        weights = self.weights(numbers, np.array([counts[n] for n in numbers.tolist()]), self.idf)
        near = self.nearest(numbers, weights, _NEAREST)
        votes = [(min(cosine, 1.0) ** _SHARPNESS, self.labels[row]) for cosine, row in near]
        mass = sum(weight for weight, _ in votes) + _PRIOR_WEIGHT
        score = (sum(weight * label for weight, label in votes) + _PRIOR_WEIGHT * self.base) / mass
        proof = [{"doc_id": self.ids[row], "label": int(self.labels[row]), "cosine": cosine} for cosine, row in near[:_EVIDENCE]]
        return float(score), proof


class TermMemory(dict):
    """Term numbers by word."""

    def __init__(self, names: dict[str, int]):
        self.names = names

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) > _MEMO_LIMIT:
            self.clear()
        numbers = tuple(self.names[t] for t in terms_of(word) if t in self.names)
        self[word] = numbers
        return numbers

    def count(self, text: str | None) -> Counter:
        counts: Counter = Counter()
        for numbers in filter(None, map(self.__getitem__, words_of(text))):
            counts.update(numbers)
        return counts


def _vectors(names):
    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = TermMemory(names)
        for batch in batches:
            counts = [sorted(memory.count(text).items()) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([[n for n, _ in own] for own in counts], pa.list_(pa.int32())),
                    pa.array([[c for _, c in own] for own in counts], pa.list_(pa.int32())),
                ],
                names=["doc_id", "label", "numbers", "counts"],
            )

    return vectors


def fit(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES, max_terms: int = MAX_TERMS) -> dict:
    """Fit on at most ``max_examples`` rows of ``labels`` (doc_id, label).

    The driver receives at most ``max_terms`` terms and ``max_examples`` short vectors. Without any
    example every text scores 0; without a telling term every text scores the base rate."""
    examples = examples_of(docs, labels, max_examples)
    n, toxic = examples.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    clean = n - toxic
    counts = examples.select("label", "text").mapInArrow(_count_terms, "term string, clean bigint, toxic bigint")
    counts = counts.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    held = F.col("clean") + F.col("toxic")
    cross = F.col("toxic") * F.lit(float(clean)) - F.col("clean") * F.lit(float(toxic))
    chi2 = F.lit(float(n)) * cross * cross / (held * (F.lit(float(n)) - held) * F.lit(float(max(1, toxic * clean))) + F.lit(1e-9))
    terms = (
        counts.filter(held >= _LEAST_EXAMPLES)
        .select("term", held.alias("held"), chi2.alias("chi2"))
        .filter(F.col("chi2") >= _LEAST_CHI2)
        .orderBy(F.desc("chi2"), "term")
        .limit(max_terms)
        .collect()
    )
    names = {row.term: number for number, row in enumerate(terms)}
    rows = examples.select("doc_id", "label", "text").mapInArrow(
        _vectors(names), "doc_id bigint, label int, numbers array<int>, counts array<int>"
    )
    vectors = [(r.doc_id, r.label, r.numbers, r.counts) for r in rows.collect()]
    return Index.build([(r.term, r.held) for r in terms], vectors, n, toxic / n if n else 0.0)


def _judge(shared):
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = Index(shared.value)
        memory, known = TermMemory(index.names), {}
        for texts in batches:
            scores, proofs = [], []
            for text in values_of(texts):
                counts = memory.count(text)
                key = tuple(sorted(counts.items()))
                if key not in known:
                    if len(known) > 5_000:
                        known.clear()
                    known[key] = index.judge(counts)
                score, proof = known[key]
                scores.append(score)
                proofs.append(proof)
            yield pa.StructArray.from_arrays([pa.array(scores, pa.float64()), pa.array(proofs, _PROOF)], ["score", "evidence"])

    return judge


def score_toxicity(docs: DataFrame, model: dict, text: str = "text", toxicity: str = "toxicity") -> DataFrame:
    """Add ``toxicity``: ``score`` from 0 to 1 and ``evidence``, the nearest examples that share a term.

    Only the text is looked at. Null and empty texts, and texts without a telling term, get the rate of
    such examples and no evidence. A column of that name is replaced. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.withColumn(toxicity, F.arrow_udf(_judge(shared), RESULT)(F.col(text)))
