"""Exact top-k inner products by histogram selection.

All candidates are scored against a block of queries where they lie, and only histograms of the scores leave
the tasks. The global histograms tell in which bin the k-th best score of each query is; that bin is parted
again until it is one score wide or holds few candidates. A last pass keeps the scores from there on, and ties
go to the smaller id. Work is queries times rows by its nature; memory is bounded by the block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Queries that are broadcast together, bins of a histogram, and candidates that are scored at once.
QUERIES, BINS, CHUNK = 2048, 512, 2048
#: Candidates beyond k that may stand in the last bin of a query when its histogram is not parted further.
SLACK = 64


def quantized(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """``id, v``: floor(scale * x) of each component; rows with null ids, or null or non-finite components, go."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vector_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return vectors.filter(F.col(id_col).isNotNull() & F.coalesce(finite, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), whole.alias("v"))


@dataclass
class Block:
    """Queries of one length, and for each where its scores are still looked at: from ``low``, bins ``width`` wide, below ``high``."""

    ids: np.ndarray
    vectors: np.ndarray
    low: np.ndarray
    width: np.ndarray
    high: np.ndarray


def _matrices(batch: pa.RecordBatch, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    column = batch.column("v")
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    fit = np.flatnonzero(np.diff(offsets) == size)
    ids = batch.column("id").to_numpy()
    for start in range(0, len(fit), CHUNK):
        rows = fit[start : start + CHUNK]
        yield ids[rows], values[offsets[rows][:, None] + np.arange(size)]


def _scores(block: Block, ids: np.ndarray, vectors: np.ndarray, exact: bool) -> tuple[np.ndarray, np.ndarray]:
    """Scores of all queries (rows) and candidates, and which of them do not count: a query's own row."""
    scores = block.vectors @ vectors.T if exact else (block.vectors.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
    return scores, block.ids[:, None] == ids[None, :]


def _histograms(shared, exact: bool) -> Callable:
    def count(batches):
        block, most = shared.value, BINS
        total = np.zeros(len(block.ids) * most, np.int64)
        for batch in batches:
            for ids, vectors in _matrices(batch, block.vectors.shape[1]):
                scores, own = _scores(block, ids, vectors, exact)
                at = (scores - block.low[:, None]) // block.width[:, None]
                # The bins of a refined histogram can end beyond the bin that they part.
                inside = (at >= 0) & (at < most) & (scores < block.high[:, None]) & ~own
                query, candidate = np.nonzero(inside)
                total += np.bincount(query * most + at[query, candidate], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some // most), pa.array(some % most), pa.array(total[some])], names=["query", "bin", "n"])

    return count


def _kept(shared, exact: bool, k: int) -> Callable:
    def keep(batches):
        block = shared.value
        for batch in batches:
            for ids, vectors in _matrices(batch, block.vectors.shape[1]):
                scores, own = _scores(block, ids, vectors, exact)
                query, candidate = np.nonzero((scores >= block.low[:, None]) & ~own)
                score, vec = scores[query, candidate], ids[candidate]
                order = np.lexsort((vec, -score, query))
                query, score, vec = query[order], score[order], vec[order]
                first = np.searchsorted(query, query)
                best = np.arange(len(query)) - first < k
                yield pa.record_batch([pa.array(query[best]), pa.array(vec[best]), pa.array(score[best])], names=["query", "vec_id", "score"])

    return keep


def _blocks(queries: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    waiting: dict[int, list] = {}
    for row in queries.toLocalIterator():
        own = waiting.setdefault(len(row.v), [])
        own.append(row)
        if len(own) == QUERIES:
            yield np.array([r.id for r in own]), np.array([r.v for r in own], np.int64).reshape(len(own), -1)
            own.clear()
    for own in waiting.values():
        if own:
            yield np.array([r.id for r in own]), np.array([r.v for r in own], np.int64).reshape(len(own), -1)


def _needs(candidates: DataFrame, need: np.ndarray) -> DataFrame:
    return candidates.sparkSession.createDataFrame([(i, int(n)) for i, n in enumerate(need)], "query long, need long")


def _selected(candidates: DataFrame, ids: np.ndarray, vectors: np.ndarray, largest: int, k: int) -> DataFrame:
    context = candidates.sparkSession.sparkContext
    bound = np.abs(vectors).sum(axis=1) * largest + 1
    exact = bool((np.abs(vectors).astype(np.float64).sum(axis=1) * largest >= 2.0**53).any())
    low, width, high = -bound, 2 * bound // BINS + 1, bound.copy()
    above, open_ = np.zeros(len(ids), np.int64), np.ones(len(ids), bool)
    while open_.any():
        shared = context.broadcast(Block(ids[open_], vectors[open_], low[open_], width[open_], high[open_]))
        counts = candidates.mapInArrow(_histograms(shared, exact), "query long, bin long, n long").groupBy("query", "bin").agg(F.sum("n").alias("n"))
        ahead = F.sum("n").over(Window.partitionBy("query").orderBy(F.desc("bin")))
        reached = counts.withColumn("ahead", ahead).join(_needs(candidates, k - above[open_]), "query").filter("ahead >= need")
        found = {r.query: r.top for r in reached.groupBy("query").agg(F.max(F.struct("bin", "n", "ahead")).alias("top")).collect()}
        for row, at in enumerate(np.flatnonzero(open_).tolist()):
            if row not in found:
                open_[at] = False  # fewer than k in all: every score counts
                continue
            place, n, ahead = found[row]
            low[at] += place * width[at]
            high[at] = min(high[at], low[at] + width[at])
            above[at] += ahead - n
            if width[at] == 1 or above[at] + n <= k + SLACK:
                open_[at] = False
            width[at] = width[at] // BINS + 1
    shared = context.broadcast(Block(ids, vectors, low, width, high))
    kept = candidates.mapInArrow(_kept(shared, exact, k), "query long, vec_id long, score long")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = kept.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    own = candidates.sparkSession.createDataFrame([(i, int(x)) for i, x in enumerate(ids)], "query long, query_id long")
    return ranked.join(own, "query").select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` best rows of ``vectors`` by integer inner product.

    Components become floor(scale * x). Rows of a query's own id are no candidates for it. Scores fall with the
    rank, ties go to the smaller id; with fewer candidates all are returned. Rows with a null id or vector, or
    a null or non-finite component, take no part on either side; vectors of another length than the query's
    are no candidates. A query row that is repeated is answered as often. Sums beyond 64 bits wrap around.
    Other columns are ignored; without queries or vectors the result is empty.
    """
    spark = vectors.sparkSession
    candidates = quantized(vectors, id_col, vector_col, scale)
    largest = candidates.agg(F.max(F.array_max(F.transform("v", lambda x: F.abs(x))))).first()[0] or 0
    parts = [_selected(candidates, ids, rows, int(largest), k) for ids, rows in _blocks(quantized(queries, id_col, vector_col, scale))]
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    return found
