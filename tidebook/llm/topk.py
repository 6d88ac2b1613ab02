"""Exact top-k search by inner product with a three-phase uniform threshold.

The dimensions are cut into `SLICES` slices. Each slice has its own list of scores, and a vector's score
is the sum over the lists.

1. Every task gathers the head of each list, slice by slice, and resolves the heads' whole scores: the
   k-th best of them is a safe cutoff, as the true k-th best can't be lower.
2. The cutoffs are broadcast. A vector that reaches a cutoff must reach its uniform share, cutoff /
   `SLICES`, in one list at least, so each list hands over its entries from the share on and no others.
   Where lengths show that no entry of a list can (Cauchy-Schwarz), its scores aren't computed.
3. What the lists didn't hand over lies below the share: that bounds a vector's score from above. Those
   bounded below the cutoff are discarded; for the others the missing scores are resolved exactly.

Queries are worked on in blocks of `BLOCK_BYTES`, so that what is broadcast doesn't grow.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SLICES = 4
#: Bytes of the queries' vectors that are broadcast at once.
BLOCK_BYTES = 16 << 20
#: Queries and vectors of one matrix product.
TILE, ROWS = 512, 2048


def scaled(vector: str, factor: float = 256.0) -> F.Column:
    """floor(factor * x) of each component, as double; null for one that isn't finite, as floor gives a long."""
    return F.transform(F.col(vector), lambda x: F.when(~F.isnan(x) & (F.abs(x) < float("inf")), F.floor(x.cast("double") * F.lit(factor)).cast("double")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def slices_of(width: int) -> list[slice]:
    edges = np.linspace(0, width, min(SLICES, width) + 1).astype(int).tolist()
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def heads(queries: np.ndarray, vectors: np.ndarray, others: np.ndarray, k: int) -> np.ndarray:
    """Phase 1: for each query the k best whole scores (or fewer, then -inf) of the vectors at the heads of
    its lists. `others` tells which vectors are candidates of a query."""
    n, rows = min(k, len(vectors)), np.arange(len(queries))[:, None]
    found = []
    for part in slices_of(queries.shape[1]):
        local = queries[:, part] @ vectors[:, part].T
        local[~others] = -np.inf
        found.append(np.argpartition(-local, n - 1, axis=1)[:, :n])
    at = np.sort(np.concatenate(found, axis=1), axis=1)
    new = np.concatenate([np.ones((len(queries), 1), bool), at[:, 1:] != at[:, :-1]], axis=1) & others[rows, at]
    whole = np.full(at.shape, -np.inf)
    q, c = np.nonzero(new)
    whole[q, c] = np.einsum("ij,ij->i", queries[q], vectors[at[q, c]])
    best = np.full((len(queries), k), -np.inf)
    best[:, : min(k, at.shape[1])] = -np.sort(-whole, axis=1)[:, :k]
    return best


def sufficient(queries: np.ndarray, vectors: np.ndarray, others: np.ndarray, cutoff: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Phases 2 and 3: query, vector and score of all pairs that reach the query's cutoff, and for how many
    pairs a missing score was resolved. All components and cutoffs are integral (or -inf)."""
    parts = slices_of(queries.shape[1])
    with np.errstate(invalid="ignore"):
        share = np.ceil(cutoff / len(parts))[:, None]
    known, lists = np.zeros(others.shape), np.zeros(others.shape, np.int8)
    listed = []
    for part in parts:
        q, v = queries[:, part], vectors[:, part]
        longest, length = np.sqrt((q * q).sum(axis=1)), np.sqrt((v * v).sum(axis=1))
        # a vector that can't reach any query's share in this list has no entry in it
        may = np.flatnonzero(length * (1 + 1e-9) * longest.max(initial=0) >= share.min(initial=np.inf))
        local = q @ v[may].T
        here = np.zeros(others.shape, bool)
        here[:, may] = (local >= share) & others[:, may]
        known[:, may] += np.where(here[:, may], local, 0.0)
        lists += here
        listed.append(here)
    row, col = np.nonzero(lists)
    missing = len(parts) - lists[row, col].astype(np.int64)
    with np.errstate(invalid="ignore"):  # an unlisted score is integral and below the share, so at most share - 1
        most = known[row, col] + np.where(missing > 0, missing * (share[row, 0] - 1), 0.0)
    left = most >= cutoff[row]
    row, col, missing = row[left], col[left], missing[left]
    total = known[row, col]
    for part, here in zip(parts, listed, strict=True):
        need = np.flatnonzero(~here[row, col])
        total[need] += np.einsum("ij,ij->i", queries[row[need], part], vectors[col[need], part])
    good = total >= cutoff[row]
    return row[good], col[good], total[good], int((missing > 0).sum())


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (long) of the k best of `candidates` for each of `queries`.

    Both have vec_id (long) and vec (array of double with integral values, so that sums are exact).
    Rows whose vec_id is the query's are its own and no candidates for it. Higher scores come first,
    ties go to the smaller vec_id; with fewer candidates all are returned. Vectors that are null, have
    null or non-finite components or another length than most queries' (or a null vec_id) take no
    part. Repeated candidate rows are candidates each, repeated query rows count once. No queries or
    no candidates give no rows. Vectors may be of any length: blocks are measured in bytes.
    """
    good = "vec_id IS NOT NULL AND vec IS NOT NULL AND forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    columns = ["vec_id", "vec"]
    asked = written(queries.select(*columns).filter(good).distinct(), "queries")
    size = asked.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").head()
    out_schema = "query_id long, rank int, vec_id long, score long"
    spark = candidates.sparkSession
    if size is None or size["d"] < 1:
        return spark.createDataFrame([], out_schema)
    width = size["d"]
    asked = asked.filter(F.size("vec") == width)
    pool = candidates.select(*columns).filter(good).filter(F.size("vec") == width)
    blocks = -(-size["count"] * 8 * width // BLOCK_BYTES)
    results = []
    for i in range(blocks):
        mine = asked.filter(F.pmod(F.xxhash64("vec_id", "vec"), F.lit(blocks)) == i).orderBy("vec_id").toArrow()
        if mine.num_rows:
            ids, matrix = mine.column("vec_id").to_numpy(), _matrix(mine.column("vec").combine_chunks(), width)
            results.append(_one_block(pool, ids, matrix, k))
    if not results:
        return spark.createDataFrame([], out_schema)
    best = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return reduce(DataFrame.unionByName, results).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _one_block(pool: DataFrame, ids: np.ndarray, matrix: np.ndarray, k: int) -> DataFrame:
    context = pool.sparkSession.sparkContext
    width = matrix.shape[1]
    shared = context.broadcast((ids, matrix))

    def tiles(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        """The queries of a tile, the vectors and their ids, and which are candidates."""
        ids, _ = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                vec_id, vectors = part.column("vec_id").to_numpy(zero_copy_only=False), _matrix(part.column("vec"), width)
                for q in range(0, len(ids), TILE):
                    own = slice(q, min(q + TILE, len(ids)))
                    yield own, vectors, vec_id, vec_id[None, :] != ids[own, None]

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix = shared.value
        best = np.full((len(ids), k), -np.inf)
        for own, vectors, _, others in tiles(batches):
            both = np.concatenate([best[own], heads(matrix[own], vectors, others, k)], axis=1)
            best[own] = -np.partition(-both, k - 1, axis=1)[:, :k]
        row, col = np.nonzero(best > -np.inf)
        if len(row):
            yield pa.RecordBatch.from_arrays([pa.array(row.astype(np.int32)), pa.array(best[row, col])], ["q", "score"])

    gathered = pool.mapInArrow(gather, "q int, score double")
    place = Window.partitionBy("q").orderBy(F.desc("score"))
    kth = gathered.withColumn("n", F.row_number().over(place)).filter(F.col("n") == k).select("q", "score").collect()
    # at most one row a query of this block; without k candidates there is no cutoff
    cutoff = np.full(len(ids), -np.inf)
    for r in kth:
        cutoff[r["q"]] = r["score"]
    limits = context.broadcast(cutoff)

    def collect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix = shared.value
        for own, vectors, vec_id, others in tiles(batches):
            row, col, total, _ = sufficient(matrix[own], vectors, others, limits.value[own])
            if len(row):
                yield pa.RecordBatch.from_arrays([pa.array(ids[own][row]), pa.array((row + own.start).astype(np.int32)), pa.array(vec_id[col]), pa.array(total.astype(np.int64))], ["query_id", "q", "vec_id", "score"])

    out = written(pool.mapInArrow(collect, "query_id long, q int, vec_id long, score long"), "enough")
    for done in (shared, limits):  # the table is written, nothing reads them any more
        done.destroy()
    return out
