"""Nearest neighbours by inner product as a block matrix join.

Vectors are packed into blocks that hold int8 codes beside the originals. Each pair of a query block
and a candidate block is one tile: the product of the codes gives every inner product up to a proven
error, pairs that cannot be among the best are dropped by it, and the rest are computed again in
double precision. A task merges the best of its tiles with one heap a query, a ranking the best of
all tasks. The result is exact.

Every vector is brought to largest component 1 by a power of two before codes, norms and bounds are
made, which changes no digit; the power stands beside it. So no bound overflows or vanishes, however large or
small the components, and a bound that is no number lets its pair survive.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cofferline.llm.common import stored

_SLACK = 1e-9  # relative room for rounding in the bounds themselves
_BLOCK = "block int, dim int, n int, ids binary, vectors binary, codes binary, scales binary, errors binary, norms binary, powers binary"
_PARTS = {
    "ids": np.int64, "vectors": np.float64, "codes": np.int8, "scales": np.float64, "errors": np.float64, "norms": np.float64, "powers": np.int64,
}
_BEST = "query_id bigint, vec_id bigint, score double"


def usable_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Distinct (vec_id, vector) rows that can take part: an id, and a vector that is neither null nor
    empty nor all zero and holds no null, infinite or not-a-number component."""
    rows = df.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    return rows.filter(F.col("vec_id").isNotNull() & fine & some).distinct()


def _pack(key: tuple, table: pa.Table) -> pa.Table:
    block, dim = key[0].as_py(), key[1].as_py()
    ids = table["vec_id"].to_numpy().astype(np.int64)
    vectors = table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    # largest components between 1/2 and 1; subnormal numbers get there in two exact steps
    powers = np.frexp(np.abs(vectors).max(axis=1))[1].astype(np.int64)
    unit = np.ldexp(np.ldexp(vectors, -(powers // 2)[:, None]), -(powers - powers // 2)[:, None])
    scales = np.abs(unit).max(axis=1) / 127.0
    codes = np.clip(np.rint(unit / scales[:, None]), -127, 127).astype(np.int8)
    errors = np.linalg.norm(unit - codes * scales[:, None], axis=1)
    columns = {
        "block": pa.array([block], pa.int32()),
        "dim": pa.array([dim], pa.int32()),
        "n": pa.array([len(ids)], pa.int32()),
    }
    parts = zip(_PARTS, (ids, vectors, codes, scales, errors, np.linalg.norm(unit, axis=1), powers), strict=True)
    for name, values in parts:
        columns[name] = pa.array([np.ascontiguousarray(values).tobytes()], pa.binary())
    return pa.table(columns)


def blocks(vectors: DataFrame, rows: int, size: int) -> DataFrame:
    """Pack ``rows`` vectors into blocks of about ``size``; a hash of id and vector deals them evenly."""
    parts = max(1, -(-rows // size))
    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(parts)).cast("int"))
    return dealt.withColumn("dim", F.size("vector")).groupBy("block", "dim").applyInArrow(_pack, _BLOCK)


def _unpacked(row: dict, side: str) -> dict[str, np.ndarray]:
    out = {name: np.frombuffer(row[f"{side}_{name}"], kind) for name, kind in _PARTS.items()}
    return out | {name: out[name].reshape(-1, row["dim"]) for name in ("vectors", "codes")}


def best_of_tile(queries: dict, candidates: dict, k: int) -> list[tuple[int, int, float]]:
    """The ``k`` best candidates of every query within one tile, exactly, as (query row, vec_id, score).

    Inner products are compared in units of the query's power times the block's largest one. Candidates
    far smaller than that become subnormal or 0 there; an error term for this keeps the bounds true. Another
    one stands for what double precision loses among the least numbers. Pairs that may overflow there survive.
    """
    dim = queries["codes"].shape[1]
    kind = np.float32 if dim * 127 * 127 < 2**24 else np.float64  # integers are exact in either
    product = (queries["codes"].astype(kind) @ candidates["codes"].astype(kind).T).astype(np.float64)
    top = int(candidates["powers"].max())
    steps = np.clip(candidates["powers"] - top, -1100, 0)
    scales, errors, norms = (np.ldexp(candidates[name], steps) for name in ("scales", "errors", "norms"))
    product *= queries["scales"][:, None] * scales[None, :]
    known = queries["norms"] + queries["errors"]
    error = queries["errors"][:, None] * norms[None, :] + known[:, None] * errors[None, :]
    shift = queries["powers"] + top
    with np.errstate(over="ignore"):
        lost = dim * (np.ldexp(1.0, np.clip(-1074 - shift, -1100, 1100)) + 2.0**-1000)
        limit = np.ldexp(1.0, np.clip(1023 - shift, -1100, 1100))
    lengths = queries["norms"][:, None] * norms[None, :]
    error += _SLACK * lengths + lost[:, None]
    error[lengths * (1 + _SLACK) >= limit[:, None]] = np.inf
    own = queries["ids"][:, None] == candidates["ids"][None, :]
    least, most = np.where(own, -np.inf, product - error), np.where(own, -np.inf, product + error)
    least[np.isnan(least)], most[np.isnan(most)] = -np.inf, np.inf
    _, copies = np.unique(candidates["ids"], return_counts=True)
    depth = k * int(copies.max())  # an id may have several vectors
    if depth < least.shape[1]:
        kth = np.partition(least, least.shape[1] - depth, axis=1)[:, least.shape[1] - depth]
    else:
        kth = np.full(len(least), -np.inf)
    rows, columns = np.nonzero(~(most < kth[:, None]) & ~own)
    scores, left, right = np.zeros(len(rows)), queries["vectors"], candidates["vectors"]
    with np.errstate(over="ignore", invalid="ignore"):
        for d in range(dim):
            scores += left[rows, d] * right[columns, d]
    out, ends = [], np.searchsorted(rows, np.arange(len(left) + 1))
    for q in range(len(left)):
        span = slice(ends[q], ends[q + 1])
        pairs = zip(_descending(scores[span]).tolist(), candidates["ids"][columns[span]].tolist(), scores[span].tolist(), strict=True)
        seen: set[int] = set()
        for _, vec_id, score in heapq.nsmallest(depth, pairs):
            if vec_id not in seen and len(seen) < k:
                seen.add(vec_id)
                out.append((q, vec_id, score))
    return out


def _descending(scores: np.ndarray) -> np.ndarray:
    """Numbers that sort scores from the highest; what is no number, of infinities of both signs, comes
    first, as Spark and SQL sort it."""
    return np.where(np.isnan(scores), -np.inf, -scores)


def _tiler(k: int):
    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best of all tiles of a task, by one heap a query; it holds the queries of one block at a time."""
        block, queries, heaps = None, {}, []

        def told() -> Iterator[pa.RecordBatch]:
            best = [(int(queries["ids"][q]), vec_id, score) for q, heap in enumerate(heaps) for _, vec_id, score in _merged(heap, k)]
            if best:
                columns = list(zip(*best, strict=True))
                kinds = (pa.int64(), pa.int64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["query_id", "vec_id", "score"])

        for batch in batches:
            for at in range(len(batch)):
                row = batch.slice(at, 1).to_pylist()[0]
                if (row["q_block"], row["dim"]) != block:
                    yield from told()
                    block, queries = (row["q_block"], row["dim"]), _unpacked(row, "q")
                    heaps = [[] for _ in queries["ids"]]
                candidates = _unpacked(row, "c")
                floors = np.array([heap[k - 1][2] if len(heap) >= k else -np.inf for heap in heaps])
                floors[np.isnan(floors)] = -np.inf
                if (floors > -np.inf).all() and _skipped(queries, candidates, floors):
                    continue
                for q, vec_id, score in best_of_tile(queries, candidates, k):
                    heaps[q].append((float(_descending(np.array(score))), vec_id, score))
                heaps = [_merged(heap, k) for heap in heaps]
        yield from told()

    return tiles


def _merged(heap: list[tuple], k: int) -> list[tuple]:
    """The first ``k`` candidates, each with its best score."""
    seen, out = set(), []
    for entry in heapq.nsmallest(len(heap), heap):
        if entry[1] not in seen and len(out) < k:
            seen.add(entry[1])
            out.append(entry)
    return out


def _skipped(queries: dict, candidates: dict, floors: np.ndarray) -> bool:
    """Whether no candidate of a block can reach the floor of any query, by the product of norms. Compared
    as logarithms, which neither overflow nor vanish; scores near the least numbers make no floor."""
    longest = (np.log2(candidates["norms"]) + candidates["powers"]).max()
    reach = np.log2(queries["norms"]) + queries["powers"] + longest + 1e-6
    with np.errstate(divide="ignore", invalid="ignore"):
        return bool(((floors > 1e-290) & (floors < np.inf) & (reach < np.log2(floors))).all())


def nearest(
    queries: DataFrame,
    candidates: DataFrame,
    k: int = 20,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    query_block: int = 1024,
    candidate_block: int = 4096,
) -> DataFrame:
    """The ``k`` candidates of largest inner product for every query: query_id, rank, vec_id, score.

    A candidate that has the query's id is its own row and left out. Ties go to the smaller vec_id.
    Rows that cannot take part (see ``usable_vectors``) are left out on both sides; repeated rows
    count once, and an id with several vectors keeps its best score. Vectors meet only vectors of the
    same length. Fewer candidates than ``k`` give them all; empty tables give no rows. A tile holds
    two blocks, whatever the size of the tables.
    """
    left, right = usable_vectors(queries, vec_id, vector), usable_vectors(candidates, vec_id, vector)
    n_left, n_right = left.count(), right.count()
    q, c = stored(blocks(left, n_left, query_block), "queries"), blocks(right, n_right, candidate_block)
    q = q.select(F.col("block").alias("q_block"), "dim", *[F.col(p).alias(f"q_{p}") for p in _PARTS])
    c = c.select("block", "dim", *[F.col(p).alias(f"c_{p}") for p in _PARTS])
    # query blocks are copied to every candidate block; a task then goes through its tiles query block by
    # query block, so that one set of heaps is enough, and the tiles themselves do not move again
    places = F.explode(F.sequence(F.lit(0), F.lit(max(1, -(-n_right // candidate_block)) - 1)))
    tiles = q.withColumn("block", places).join(c, ["block", "dim"]).sortWithinPartitions("dim", "q_block")
    tiles = tiles.mapInArrow(_tiler(k), _BEST)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        tiles.groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
