"""Approximate nearest neighbours by multiprobe p-stable hashing, with exact distances for all candidates of a probe."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.llm import blocks
from corvane.session import cut_lineage


@dataclass
class Index:
    """Directions, offsets and width of the hash functions: ``tables`` tables of ``functions`` each."""

    directions: np.ndarray  # (tables, functions, dimension)
    offsets: np.ndarray  # (tables, functions), in widths
    width: float
    probes: list[tuple[int, ...]]  # sets of perturbations by rank, in estimated success order

    def places(self, vectors: np.ndarray) -> np.ndarray:
        """Where vectors lie along each direction, in widths: (rows, tables, functions)."""
        return np.einsum("nd,tfd->ntf", vectors, self.directions, optimize=True) / self.width + self.offsets

    def keys(self, cells: np.ndarray) -> np.ndarray:
        """A 64-bit key for cells (..., tables, functions), with the table in it."""
        out = np.broadcast_to(np.arange(cells.shape[-2], dtype=np.uint64), cells.shape[:-1]).copy()
        for f in range(cells.shape[-1]):
            out = blocks.mix(out ^ cells[..., f].astype(np.int64).view(np.uint64), 50)
        return blocks.signed(out)

    def probe_keys(self, vectors: np.ndarray) -> np.ndarray:
        """Keys of the buckets that queries visit: (rows, tables, probes), the own bucket first.

        For each query and table the 2 * functions one-step moves (down or up in one function) are ranked by the
        distance to the wall they cross; a set of ranks names the moves of a probe. A set that would move one function
        both ways is never among ``probes``, as rank j and rank 2 * functions + 1 - j are the two moves of one.
        """
        places = self.places(vectors)
        cells = np.floor(places)
        down = places - cells
        walls = np.concatenate([down, 1 - down], axis=-1)  # move f: down for f < functions, else up
        order = np.argsort(walls, axis=-1, kind="stable")
        count = cells.shape[-1]
        out = np.empty((*cells.shape[:2], len(self.probes)), dtype=np.int64)
        for p, ranks in enumerate(self.probes):
            moved = cells.copy()
            for rank in ranks:
                move = order[..., rank - 1]
                step = np.where(move < count, -1.0, 1.0)
                np.put_along_axis(moved, (move % count)[..., None], np.take_along_axis(moved, (move % count)[..., None], -1) + step[..., None], -1)
            out[..., p] = self.keys(moved)
        return out


def probe_order(functions: int, probes: int) -> list[tuple[int, ...]]:
    """Sets of move ranks by ascending expected squared distance, from the order statistics of uniform wall distances.

    The heap grows each set by its next rank or shifts its last one, which visits the sets in order.
    """
    m = functions
    cost = [0.0] * (2 * m + 1)
    for j in range(1, m + 1):
        cost[j] = j * (j + 1) / (4.0 * (m + 1) * (m + 2))
        cost[2 * m + 1 - j] = 1 - j / (m + 1.0) + cost[j]
    out: list[tuple[int, ...]] = [()]
    heap = [(cost[1], (1,))]
    while heap and len(out) < probes:
        total, ranks = heapq.heappop(heap)
        if len(ranks) == len({min(r, 2 * m + 1 - r) for r in ranks}):
            out.append(ranks)
        last = ranks[-1]
        if last < 2 * m:
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*ranks[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*ranks, last + 1)))
    return out


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``(id, x)`` of the vectors that take part: of the most frequent length (ties: the smaller), finite, not zero."""
    real = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("x"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("x").isNotNull() & F.forall("x", real) & F.exists("x", lambda v: v != 0))
    length = rows.groupBy(F.size("x").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.col("rows").desc(), "n").first()
    return rows.filter(F.size("x") == (length["n"] if length else 0))


def _matrix(lists: pa.Array) -> np.ndarray:
    bounds = lists.offsets.to_numpy()
    return lists.values.to_numpy()[bounds[0] : bounds[-1]].reshape(len(lists), -1)


def _scan(rows: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int, index: Index | None) -> DataFrame:
    """The ``k`` nearest rows of each task for a block of queries: ``(query_id, vec_id, score)``.

    With an index a row counts for a query only if one of the query's probes visits one of the row's buckets. A task
    holds the block and ``k`` rows per query, whatever its rows are; a bucket of any size passes by in slices.
    """
    visits = None if index is None else index.probe_keys(queries)
    square = (queries * queries).sum(1)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best_id = np.full((len(ids), k), np.iinfo(np.int64).max)
        best = np.full((len(ids), k), np.inf)
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                own, x = part.column(0).to_numpy(), _matrix(part.column(1))
                other = ids[:, None] != own[None, :]
                if index is not None:
                    met = np.zeros((len(own), len(ids)), dtype=bool)
                    keys = index.keys(np.floor(index.places(x)))
                    for t in range(keys.shape[1]):
                        buckets, member = np.unique(keys[:, t], return_inverse=True)
                        at = np.minimum(np.searchsorted(buckets, visits[:, t]), len(buckets) - 1)
                        query, probe = np.nonzero(buckets[at] == visits[:, t])
                        visited = np.zeros((len(buckets), len(ids)), dtype=bool)
                        visited[at[query, probe], query] = True
                        met |= visited[member]
                    other &= met.T
                rough = np.maximum(square[:, None] + (x * x).sum(1)[None, :] - 2 * queries @ x.T, 0)
                rough[~other] = np.inf
                # squared distances from the product are off by rounding only: a little slack keeps all that can count
                last = np.minimum(best[:, -1] ** 2, np.partition(rough, min(k, rough.shape[1]) - 1, axis=1)[:, min(k, rough.shape[1]) - 1] if rough.shape[1] >= k else np.inf)
                slack = 1e-9 * (square + (x * x).sum(1).max())
                for q in np.flatnonzero((rough <= (last + slack)[:, None]).any(axis=1) & other.any(axis=1)):
                    near = np.flatnonzero((rough[q] <= last[q] + slack[q]) & other[q])
                    score = np.sqrt(((x[near] - queries[q]) ** 2).sum(1))
                    score, name = np.concatenate([best[q], score]), np.concatenate([best_id[q], own[near]])
                    order = np.lexsort((name, score))[:k]
                    best[q], best_id[q] = score[order], name[order]
        query, rank = np.nonzero(np.isfinite(best))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[query]), pa.array(best_id[query, rank]), pa.array(best[query, rank])], names=["query_id", "vec_id", "score"]
        )

    return rows.mapInArrow(nearest, "query_id bigint, vec_id bigint, score double")


def _merge(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each query over all tasks, ranked from 1; ties go to the smaller id."""
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def fit_index(
    rows: DataFrame, k: int, tables: int = 6, functions: int = 10, probes: int = 60, recall: float = 0.95, sample: int = 64, seed: int = 5
) -> Index | None:
    """An index with the narrowest width that finds ``recall`` of the true neighbours of a bounded sample.

    The sample is the ``sample`` vectors of smallest hash. Their ``k`` nearest rows among all rows are found exactly, in
    one scan; widths grow by an eighth from a small one until enough of these pairs meet. None for an empty table.
    """
    picked = rows.orderBy(F.xxhash64("x", "id")).limit(sample).collect()
    if not picked:
        return None
    ids, x = np.array([r["id"] for r in picked]), np.array([r["x"] for r in picked], dtype=np.float64)
    pairs = _merge(_scan(rows, ids, x, k, None), k).select("query_id", F.col("vec_id").alias("id"), "score")
    pairs = pairs.join(rows, "id").collect()  # k * sample rows, and as many for each repeat of an id
    draw = np.random.default_rng(seed)
    directions, offsets = draw.standard_normal((tables, functions, x.shape[1])), draw.random((tables, functions))
    order = probe_order(functions, probes)
    scores = np.array([p["score"] for p in pairs])
    if not len(pairs) or not scores.any():
        return Index(directions, offsets, 1.0, order)
    near = np.array([p["x"] for p in pairs], dtype=np.float64)
    at = {i: n for n, i in enumerate(ids.tolist())}
    query = np.array([at[p["query_id"]] for p in pairs])
    width = float(np.median(scores[scores > 0])) / 2
    while True:
        index = Index(directions, offsets, width, order)
        keys, visits = index.keys(np.floor(index.places(near))), index.probe_keys(x)
        met = (visits[query] == keys[:, :, None]).any(axis=(1, 2))
        if met.mean() >= recall:
            return index
        width *= 1.125


def nearest_neighbours(
    vectors: DataFrame,
    queries: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 10,
    index: Index | None = None,
    block: int = 4096,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest rows found for each query, by Euclidean distance.

    Each table hashes a vector to the cell of its p-stable projections; a query visits its own cell and the cells
    that neighbours most likely fell into, in estimated success order, in every table. All rows of the visited buckets
    are candidates and are ranked by their exact distance in double precision; ties go to the smaller id. The rows are
    read where they lie, once for each block of ``block`` queries, which is the part that every task holds; tasks send
    ``k`` rows per query on. A query that met fewer than ``k`` rows is compared with all rows instead.

    A row is no candidate of a query with its id. Null ids, and vectors that are null, zero, of another length than most, or
    hold null or non-finite components, take no part; of queries with the same id the smallest vector counts. Empty
    tables give no rows.
    """
    rows = usable(vectors, key, vector)
    index = index or fit_index(rows, k)
    asked = usable(queries, key, vector).groupBy("id").agg(F.min("x").alias("x"))
    asked = cut_lineage(asked.withColumn("at", F.xxhash64("id")))
    total = asked.count()
    blocks_ = max(1, math.ceil(total / block))
    out = None
    if index is not None:
        found = []
        for part in range(blocks_):
            chosen = asked.filter(F.pmod("at", F.lit(blocks_)) == part).collect()  # about ``block`` rows
            if chosen:
                ids, x = np.array([r["id"] for r in chosen]), np.array([r["x"] for r in chosen], dtype=np.float64)
                near = cut_lineage(_merge(_scan(rows, ids, x, k, index), k))
                full = near.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k)
                done = {r[0] for r in full.collect()}
                short = np.array([i not in done for i in ids.tolist()])
                if short.any():
                    again = _merge(_scan(rows, ids[short], x[short], k, None), k)
                    near = near.join(full, "query_id", "left_semi").unionByName(again)
                found.append(near)
        for near in found:
            out = near if out is None else out.unionByName(near)
    if out is None:
        out = vectors.sparkSession.createDataFrame([], T.StructType.fromDDL("query_id bigint, vec_id bigint, score double, rank int"))
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
