"""Vectors stored by cell, and matching that reads only the cells a question may need.

``build_cells`` trains centres on a bounded sample, and stores every unit vector under the cell of its nearest centre, a
cell of many rows in several parts. ``cell_match`` multiplies tiles of questions with parts of cells: with ``probes`` the
nearest cells of each question, as many more as hold ``topn`` rows; without, all cells whose bound can reach the question's
results, which is exact.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.operators import ordering
from corvane.session import cut_lineage, shared_folder


@dataclass(frozen=True)
class CellStore:
    """Stored vectors ``chunk_id, v, cell, part``; of each cell its centre, rows, parts and least cosine to the centre."""

    rows: DataFrame
    centres: np.ndarray
    sizes: np.ndarray
    parts: np.ndarray
    reach: np.ndarray


def unit_rows(column: pa.Array) -> np.ndarray:
    """The vectors of a list column, brought to length one; zero vectors stay."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    matrix = flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, length, out=np.zeros_like(matrix), where=length > 0)


def train_centres(sample: np.ndarray, n: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Spherical k-means of a sample; the first centres are drawn rows."""
    centres = sample[np.random.default_rng(seed).permutation(len(sample))[:n]].copy()
    for _ in range(rounds):
        near = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 0, sums / np.where(length > 0, length, 1), centres)
    return centres


def build_cells(
    vectors: DataFrame, cells: int | None = None, sample_rows: int = 20_000, part_rows: int = 16_384, folder: str | None = None
) -> CellStore:
    """Store ``vectors(chunk_id, embedding)``; rows without a vector are left out, the others have one length.

    The centres are trained on at most ``sample_rows`` vectors, those of the least hashes of their ids. By default there
    are as many cells as the square root of the rows, 4096 at most.
    """
    spark = vectors.sparkSession
    folder = folder or f"{shared_folder(spark).rstrip('/')}/cells-{uuid.uuid4().hex}"
    usable = vectors.filter("embedding IS NOT NULL AND size(embedding) > 0").select("chunk_id", F.col("embedding").cast("array<double>").alias("embedding"))
    total = usable.count()
    kind = dict(vectors.dtypes)["chunk_id"]
    if not total:
        empty = spark.createDataFrame([], f"chunk_id {kind}, v array<double>, cell int, part int")
        return CellStore(empty, np.zeros((0, 0)), np.zeros(0, int), np.zeros(0, int), np.zeros(0))
    marked = usable.withColumn("_h", F.xxhash64(F.col("chunk_id").cast("string"), F.lit(3)))
    share = min(1.0, 1.5 * sample_rows / total)
    drawn = marked.filter(F.col("_h") < int((share - 0.5) * 2**64) if share < 1 else F.lit(True)).orderBy("_h").limit(sample_rows)
    sample = unit_rows(pa.array(drawn.toPandas()["embedding"].tolist(), pa.list_(pa.float64())))
    centres = train_centres(sample, min(cells or min(4096, max(1, int(total**0.5))), len(sample)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = unit_rows(batch.column(1))
            if not len(unit):
                continue
            near = unit @ centres.T
            cell = near.argmax(axis=1)
            offsets = pa.array(np.arange(len(unit) + 1) * unit.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(unit.ravel())), pa.array(cell.astype(np.int32)), pa.array(near.max(axis=1))],
                names=["chunk_id", "v", "cell", "near"],
            )

    placed = cut_lineage(usable.mapInArrow(assign, f"chunk_id {kind}, v array<double>, cell int, near double"))
    sizes, reach = np.zeros(len(centres), np.int64), np.ones(len(centres))
    for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("near").alias("near")).collect():
        sizes[r["cell"]], reach[r["cell"]] = r["n"], r["near"]
    parts = -(-sizes // part_rows)
    fan = F.get(F.array(*[F.lit(int(p)) for p in np.maximum(parts, 1)]), F.col("cell")) if parts.max() > 1 else F.lit(1)
    part = F.pmod(F.xxhash64(F.col("chunk_id").cast("string")), fan).cast("int")
    shaped = placed.select("chunk_id", "v", "cell", part.alias("part"))
    shaped.repartition("cell", "part").write.partitionBy("cell", "part").parquet(folder)
    return CellStore(spark.read.schema(shaped.schema).parquet(folder), centres, sizes, parts, reach)


def _bounds(store: CellStore, unit: np.ndarray) -> np.ndarray:
    """The largest cosine that a row of each cell can have with each question."""
    to_centre = np.arccos(np.clip(unit @ store.centres.T, -1, 1))
    return np.cos(np.maximum(0, to_centre - np.arccos(np.clip(store.reach, -1, 1)))) + 1e-9


def _multiplied(asked: DataFrame, store: CellStore, topn: int, min_sim: float, tile_rows: int) -> DataFrame:
    """Best rows of each question in the cells ``asked(query_id, unit, cell)``, ties at the edge included."""
    kinds = dict(asked.dtypes)["query_id"], dict(store.rows.dtypes)["chunk_id"]
    cells = [r["cell"] for r in asked.select("cell").distinct().collect()]
    parts = asked.sparkSession.createDataFrame([(int(c), p) for c in cells for p in range(int(store.parts[c]))], "cell int, part int")
    tiles = max(1, -(-asked.select("query_id").distinct().count() // tile_rows))
    tiled = asked.join(parts, "cell").withColumn("tile", F.pmod(F.xxhash64(F.col("query_id").cast("string")), F.lit(tiles)).cast("int"))
    left = tiled.select(F.col("cell").alias("of_cell"), F.col("part").alias("of_part"), F.col("tile").alias("of_tile"), "query_id", "unit")
    wanted = tiled.select("cell", "part", "tile").distinct()
    right = store.rows.filter(F.col("cell").isin(cells)).join(wanted, ["cell", "part"])

    def best(questions: pa.Table, rows: pa.Table) -> pa.Table:
        none = {"query_id": pa.nulls(0, questions["query_id"].type), "chunk_id": pa.nulls(0, rows["chunk_id"].type), "score": pa.nulls(0, pa.float64())}
        if not questions.num_rows or not rows.num_rows:
            return pa.table(none)
        questions, rows = questions.combine_chunks(), rows.combine_chunks()
        shape = lambda c: c.combine_chunks().flatten().to_numpy().reshape(len(c), -1)
        sims = shape(questions["unit"]) @ shape(rows["v"]).T
        level = np.round(sims, 6)
        edge = np.partition(level, -topn, axis=1)[:, -topn] if sims.shape[1] > topn else np.full(len(sims), -2.0)
        q, c = np.nonzero((level >= edge[:, None]) & (level >= min_sim))
        return pa.table({"query_id": questions["query_id"].take(pa.array(q)), "chunk_id": rows["chunk_id"].take(pa.array(c)), "score": sims[q, c]})

    schema = f"query_id {kinds[0]}, chunk_id {kinds[1]}, score double"
    return left.groupBy("of_cell", "of_part", "of_tile").cogroup(right.groupBy("cell", "part", "tile")).applyInArrow(best, schema)


def cell_match(
    queries: DataFrame, store: CellStore, topn: int, min_sim: float = -1.0, probes: int | None = None, tile_rows: int = 512
) -> DataFrame:
    """Cosine top ``topn`` per question ``(query_id, chunk_id, score, rank)`` of ``queries(query_id, vector)``.

    With ``probes``, the nearest cells of each question, and as many more as it takes to hold ``topn`` rows; an answer is
    short only where the whole store is. Without, the nearest cells first, then those whose bound reaches the
    ``topn``-th score found: exact.
    """
    first = probes or 2
    sizes = store.sizes
    usable = queries.filter("vector IS NOT NULL AND size(vector) > 0").select("query_id", F.col("vector").cast("array<double>").alias("vector"))
    kind = dict(queries.dtypes)["query_id"]
    schema = f"query_id {kind}, unit array<double>, cell int, bound double, early boolean"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = unit_rows(batch.column(1))
            if not len(unit):
                continue
            bounds = _bounds(store_parts, unit)
            order = np.argsort(-(unit @ store_parts.centres.T), axis=1, kind="stable")
            held = np.cumsum(sizes[order], axis=1)
            early = (np.arange(order.shape[1]) < first) | (np.concatenate([np.zeros((len(unit), 1), int), held[:, :-1]], axis=1) < topn)
            keep = (early if probes else np.ones_like(early)) & (sizes[order] > 0)
            q, at = np.nonzero(keep)
            cell = order[q, at]
            offsets = pa.array(np.arange(len(q) + 1) * unit.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(q)), pa.ListArray.from_arrays(offsets, pa.array(unit[q].ravel())), pa.array(cell.astype(np.int32)), pa.array(bounds[q, cell]), pa.array(early[q, at])],
                names=["query_id", "unit", "cell", "bound", "early"],
            )

    store_parts = CellStore(None, store.centres, store.sizes, store.parts, store.reach)
    if not len(store.centres):
        return queries.sparkSession.createDataFrame([], f"query_id {kind}, chunk_id {dict(store.rows.dtypes)['chunk_id']}, score double, rank int")
    asked = cut_lineage(usable.mapInArrow(place, schema).filter(F.col("early") | (F.col("bound") >= min_sim)))
    found = _multiplied(asked.filter("early"), store, topn, min_sim, tile_rows)
    if probes:
        return ordering.topk_per_query(found, topn)
    found = cut_lineage(found)
    mark = ordering.topk_per_query(found, topn).filter(F.col("rank") == topn).select("query_id", F.col("score").alias("mark"))
    rest = cut_lineage(asked.filter("NOT early").join(mark, "query_id", "left").filter(F.col("mark").isNull() | (F.col("bound") >= F.col("mark") - 1e-6)).select("query_id", "unit", "cell"))
    return ordering.topk_per_query(found.unionByName(_multiplied(rest, store, topn, min_sim, tile_rows)), topn)
