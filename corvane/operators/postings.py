"""A stored inverted index in blocks, and matching against it as sparse products.

``build`` cuts the chunks into blocks of consecutive rows. A block is one row of the index: the ids, field lengths and
carried columns of its chunks, and for each term the places of the chunks that hold it, their counts in each field, and the
largest impact any of them can have. Blocks are written by the tasks that read their chunks, so nothing is shuffled or
sorted to build the index; a term that every chunk holds stands once in every block.

``text_match`` brings each block together with the questions' terms that occur in it, a tile of questions at a time, and
adds up all pairs of a tile and a block in memory. Questions of a checked size are sent to the blocks, which stay where they
are; many more questions, or questions that need some blocks only, meet them through a shuffle of index rows and terms, never of
pairs. Pairs that are no hits leave no row. ``matched_counts`` is for as many questions as there are chunks: the questions of a tile travel to the
blocks, which stay where they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.operators import ordering
from corvane.session import cut_lineage, shared_folder

# Saturation and length terms of the text score.
K1, B = 1.2, 0.75
PAIRS = 1 << 21  # pairs added up at once
OWN = -1  # the lot of the rows that describe blocks
SENT = 1 << 18  # asked terms that are sent to the blocks at once
LOTS = 8  # lots of so many asked terms, each for one reading of the index
GROUP = {"parquet.block.row.count.limit": "2", "parquet.page.size.row.check.min": "1"}  # blocks that are written, and read, at once


@dataclass(frozen=True)
class PostingStore:
    """A written index: its blocks, document frequencies by term, and number and mean length of each field."""

    blocks: DataFrame
    stats: DataFrame
    n: dict[str, int]
    avg: dict[str, float]
    fields: tuple[str, ...]
    carry: tuple[str, ...]

    def postings(self, *columns: str) -> DataFrame:
        """One row per term and block, with those of the columns ``at, n, tf_, df_, top_`` that are named."""
        return _postings(self.blocks, columns)

    def own(self) -> DataFrame:
        """One row per block, with what it knows of its chunks."""
        return self.blocks.select("block", "ids", *[f"len_{f}" for f in self.fields], *self.carry)

    @property
    def rows(self) -> DataFrame:
        """Terms by block, and without term the rows that describe blocks, which have the lot -1."""
        terms = self.postings("at", "n", *[f"{p}_{f}" for f in self.fields for p in ("tf", "df", "top")]).withColumn("lot", F.lit(0))
        return terms.unionByName(self.own().withColumn("lot", F.lit(OWN)), allowMissingColumns=True)


def _postings(blocks: DataFrame, columns: Sequence[str]) -> DataFrame:
    lists = F.arrays_zip(F.col("terms").alias("term"), *[F.col(f"{c}s").alias(c) for c in columns])
    return blocks.select("block", F.explode(lists).alias("e")).select("block", "e.*")


def _norm(tf: np.ndarray, length: np.ndarray, avg: float) -> np.ndarray:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / avg)) if avg else np.zeros(len(tf))


def build(
    chunks: DataFrame,
    fields: Mapping[str, str],
    key: str = "chunk_id",
    carry: Sequence[str] = (),
    folder: str | None = None,
    block_rows: int = 2048,
) -> PostingStore:
    """Write the index of ``chunks``; ``fields`` maps a field's name to its column of tokens.

    ``carry`` names further columns that stay with the chunks. A null column of tokens counts as empty. The chunks are
    read twice, for the field lengths and for the index, so an expensive plan is better stored before.
    """
    spark = chunks.sparkSession
    folder = folder or f"{shared_folder(spark).rstrip('/')}/postings-{uuid.uuid4().hex}"
    tokens = {f: F.coalesce(F.col(c), F.array().cast("array<string>")) for f, c in fields.items()}
    source = chunks.select(F.col(key).alias("id"), *carry, *[t.alias(f"t_{f}") for f, t in tokens.items()])
    sizes = [
        x for f in fields for x in (F.count(F.when(F.size(f"t_{f}") > 0, 1)).alias(f"n_{f}"), F.sum(F.size(f"t_{f}")).alias(f"sum_{f}"))
    ]
    known = source.agg(*sizes).first()
    n = {f: known[f"n_{f}"] for f in fields}
    avg = {f: known[f"sum_{f}"] / known[f"n_{f}"] if known[f"n_{f}"] else 0.0 for f in fields}
    names, kept = list(fields), list(carry)
    kinds = dict(source.dtypes)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first in range(0, batch.num_rows, block_rows):
                yield _block_row(batch.slice(first, block_rows), block, names, kept, avg)
                block += 1

    of_terms = ", ".join(f"tf_{f}s array<array<int>>, df_{f}s array<bigint>, top_{f}s array<double>" for f in names)
    of_chunks = "".join(f", len_{f} array<int>" for f in names) + "".join(f", {c} array<{kinds[c]}>" for c in kept)
    schema = f"block bigint, terms array<string>, ats array<array<int>>, ns array<bigint>, {of_terms}, ids array<{kinds['id']}>{of_chunks}"
    rows = source.mapInArrow(index, schema)
    rows.write.options(**GROUP).parquet(folder)
    stored = spark.read.schema(rows.schema).parquet(folder)
    occurrences = sum((F.aggregate(f"tf_{f}", F.lit(0).cast("bigint"), lambda s, x: s + x) for f in names), F.lit(0).cast("bigint"))
    stats = cut_lineage(
        _postings(stored, ["n", *[f"{p}_{f}" for f in names for p in ("tf", "df")]])
        .select("term", "n", occurrences.alias("tf"), *[f"df_{f}" for f in names])
        .groupBy("term")
        .agg(F.sum("n").alias("df"), F.sum("tf").alias("tf"), *[F.sum(f"df_{f}").alias(f"df_{f}") for f in names])
    )
    return PostingStore(stored, stats, n, avg, tuple(names), tuple(kept))


def _block_row(batch: pa.RecordBatch, block: int, fields: list[str], carry: list[str], avg: dict[str, float]) -> pa.RecordBatch:
    """The index row of one block; its terms stand in ascending order."""
    d = batch.num_rows
    lists = {f: batch.column(batch.schema.get_field_index(f"t_{f}")) for f in fields}
    lengths = {f: np.diff(c.offsets.to_numpy()) for f, c in lists.items()}
    found = pa.concat_arrays([lists[f].flatten() for f in fields]).dictionary_encode()
    order = pc.sort_indices(found.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    codes, begin, cells = place[found.indices.to_numpy(zero_copy_only=False)], 0, {}
    for f in fields:
        size = int(lengths[f].sum())
        cells[f] = np.unique(codes[begin : begin + size] * d + np.repeat(np.arange(d), lengths[f]), return_counts=True)
        begin += size
    every = np.unique(np.concatenate([c for c, _ in cells.values()])) if cells else np.zeros(0, np.int64)
    at, code = (every % d).astype(np.int32), every // d
    starts = np.flatnonzero(np.diff(code, prepend=-1))
    bounds = np.append(starts, len(every)).astype(np.int32)
    terms = len(starts)
    one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    ragged = lambda values: one(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int32())))
    row = {"block": pa.array([block]), "terms": one(found.dictionary.take(pa.array(order[code[starts]]))), "ats": ragged(at), "ns": one(pa.array(np.diff(bounds).astype(np.int64)))}
    for f in fields:
        tf = np.zeros(len(every), np.int32)
        tf[np.searchsorted(every, cells[f][0])] = cells[f][1]
        impact = _norm(tf.astype(float), lengths[f][at], avg[f])
        row[f"tf_{f}s"] = ragged(tf)
        row[f"df_{f}s"] = one(pa.array(np.add.reduceat(tf > 0, starts, dtype=np.int64) if terms else np.zeros(0, np.int64)))
        row[f"top_{f}s"] = one(pa.array(np.maximum.reduceat(impact, starts) if terms else np.zeros(0)))
    row["ids"] = one(batch.column(batch.schema.get_field_index("id")))
    row |= {f"len_{f}": one(pa.array(lengths[f], pa.int32())) for f in fields}
    row |= {c: one(batch.column(batch.schema.get_field_index(c))) for c in carry}
    return pa.RecordBatch.from_arrays(list(row.values()), names=list(row))


def _asked(query_terms: DataFrame, store: PostingStore, need: Column, tile_rows: int) -> DataFrame:
    """Terms that the index has, with their frequencies, ``need`` and a tile of about ``tile_rows`` questions."""
    whole = query_terms.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_terms"))
    rows = query_terms.join(whole, "query_id").withColumn("need", need).join(store.stats, "term")
    tiles = max(1, -(-whole.count() // tile_rows))
    return cut_lineage(rows.withColumn("tile", F.pmod(F.xxhash64("query_id"), F.lit(tiles)).cast("int")))


def _met(asked: DataFrame, store: PostingStore, pairs: DataFrame | None, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Index rows and asked terms, both by tile and block; ``pairs(query_id, block)`` restricts what is met."""
    lists = ["at", *[f"tf_{f}" for f in store.fields]]
    rows = store.postings(*lists).join(asked.select("term", "tile").distinct(), "term")
    questions = asked.join(store.postings(), "term")
    if pairs is not None:
        questions = questions.join(pairs, ["query_id", "block"], "left_semi")
        held = cut_lineage(questions.select("tile", "block").distinct())
        rows = rows.join(held, ["tile", "block"], "left_semi")
    else:
        held = cut_lineage(rows.select("tile", "block").distinct())
    met = rows.unionByName(store.own().join(held, "block"), allowMissingColumns=True)
    return met, questions.select(F.col("tile").alias("of_tile"), F.col("block").alias("of_block"), *columns)


class _Tile:
    """The pairs of one block and one tile of questions that are hits: how many terms match, and the best field's sum.

    ``at`` and ``tfs`` hold the block's postings term by term, cut at ``offsets``; an asked term is the question ``q`` out of
    ``n``, its place ``of`` among the terms of the block, and a weight for each field.
    """

    def __init__(self, d: int, lengths: Mapping, offsets: np.ndarray, at: np.ndarray, tfs: Mapping, q: np.ndarray, of: np.ndarray, weights: Mapping, need: np.ndarray, avg: Mapping[str, float]):
        self.d, n = d, len(need)
        order = np.lexsort((of, q))  # sums are added up in the order of the terms, however they come
        q, of, weights = q[order], of[order], {f: w[order] for f, w in weights.items()}
        used, of = np.unique(of, return_inverse=True)  # a posting's share in the score is the same for all questions
        size, ends = np.diff(offsets)[used], np.cumsum(np.diff(offsets)[used])
        at, norms = _impacts(np.repeat(offsets[used] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0), at, tfs, lengths, avg)
        begin, size = (ends - size)[of], size[of]
        cells = n * d
        matched, sums = np.zeros(cells, np.int64), {f: np.zeros(cells) for f in tfs}
        cuts = np.append(np.unique(np.cumsum(size) // PAIRS, return_index=True)[1], len(of)) if len(of) else [0]
        for a, b in zip(cuts[:-1], cuts[1:]):
            s = size[a:b]
            ends = np.cumsum(s)
            where = np.repeat(begin[a:b] - (ends - s), s) + np.arange(ends[-1])
            cell = np.repeat(q[a:b], s) * d + at[where]
            matched += np.bincount(cell, minlength=cells)
            for f in tfs:
                sums[f] += np.bincount(cell, np.repeat(weights[f][a:b], s) * norms[f][where], cells)
        hits = np.flatnonzero(matched >= np.repeat(need, d))
        self.hits = hits[matched[hits] > 0]
        self.matched = matched[self.hits]
        self.best = np.max([np.zeros(len(self.hits)), *[sums[f][self.hits] for f in tfs]], axis=0)

    def keep_best(self, topn: int) -> None:
        """Keep the best of each question, with all that tie at the edge."""
        order = np.lexsort((-np.round(self.best, 6), self.hits // self.d))
        q, level = (self.hits // self.d)[order], np.round(self.best, 6)[order]
        start = np.flatnonzero(np.diff(q, prepend=-1))
        edge = np.minimum(start + topn, np.append(start[1:], len(q))) - 1
        keep = level >= np.repeat(level[edge], np.diff(np.append(start, len(q)))) if len(q) else np.zeros(0, bool)
        self.hits, self.best, self.matched = self.hits[order][keep], self.best[order][keep], self.matched[order][keep]

    def rows(self, queries: pa.Array, ids: pa.Array) -> list[pa.Array]:
        """Columns ``query_id, chunk_id, score, matched``."""
        return [queries.take(pa.array(self.hits // self.d)), ids.take(pa.array(self.hits % self.d)), pa.array(self.best), pa.array(self.matched)]


def _impacts(where: np.ndarray, at: np.ndarray, tfs: Mapping, lengths: Mapping, avg: Mapping[str, float]) -> tuple[np.ndarray, dict]:
    """The chunk of some postings, and for each field what they add to a score before any weight."""
    at, norms = at[where], {}
    for f, tf in tfs.items():
        tf = tf[where].astype(float)
        norms[f] = np.where(tf > 0, _norm(np.maximum(tf, 1e-300), lengths[f][at], avg[f]), 0.0)
    return at, norms


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and entries of a column of lists."""
    return lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py(), lists.flatten().to_numpy(zero_copy_only=False)


def text_match(
    query_terms: DataFrame,
    store: PostingStore,
    boosts: Mapping[str, float],
    min_match: float = 0.3,
    topn: int | None = None,
    tile_rows: int = 256,
    first_blocks: int = 4,
    skip_blocks: bool = True,
) -> DataFrame:
    """Best-field weighted text score ``(query_id, chunk_id, score, matched)`` of the chunks that match enough terms.

    ``query_terms(query_id, term, weight)`` has distinct terms per question; a chunk needs ``floor(min_match * n)`` of
    the n terms, at least one. With ``topn``, only chunks that can be among a question's best are sure to be returned:
    the ``first_blocks`` blocks of the largest possible score set a mark, and blocks that cannot reach it are not read.
    Without ``skip_blocks`` all blocks are scored and each hands on its own best, which costs less where most blocks
    can reach the mark. Where all are scored, about ``SENT`` asked terms at a time, up to ``LOTS`` times, are sent to the
    blocks, which stay where they are; each lot of questions reads the index once.
    """
    idf = lambda f: F.ln(1 + (store.n[f] - F.col(f"df_{f}") + 0.5) / (F.col(f"df_{f}") + 0.5))
    need = F.greatest(F.lit(1), F.floor(F.col("n_terms") * min_match).cast("bigint"))
    asked = _asked(query_terms, store, need, tile_rows)
    asked = asked.withColumns({f"w_{f}": F.col("weight") * float(boosts[f]) * idf(f) for f in store.fields})
    if topn is None or not skip_blocks:
        lots = max(1, -(-asked.count() // SENT))
        if lots > LOTS:
            return _scored(asked, store, None, topn)
        lot = F.pmod(F.xxhash64("query_id", F.lit("lot")), F.lit(lots))
        return reduce(DataFrame.unionByName, [_scored_in_place(asked.filter(lot == i), store, topn, tile_rows) for i in range(lots)])
    tops = store.postings(*[f"top_{f}" for f in store.fields])
    bounds = (
        asked.join(tops, "term")
        .groupBy("query_id", "block")
        .agg(F.count(F.lit(1)).alias("n"), F.max("need").alias("need"), *[F.sum(F.col(f"w_{f}") * F.col(f"top_{f}")).alias(f) for f in store.fields])
        .filter("n >= need")
        .select("query_id", "block", F.greatest(*[F.col(f) for f in store.fields], F.lit(0.0)).alias("score"))
    )
    bounds = cut_lineage(bounds)
    ranked = ordering.topk_per_query(bounds.withColumnRenamed("block", "chunk_id"), first_blocks).select("query_id", F.col("chunk_id").alias("block"))
    first = cut_lineage(ranked)
    early = cut_lineage(_scored(asked, store, first, topn))
    mark = ordering.topk_per_query(early.drop("matched"), topn).filter(F.col("rank") == topn).select("query_id", F.col("score").alias("mark"))
    rest = (
        bounds.join(first, ["query_id", "block"], "left_anti")
        .join(mark, "query_id", "left")
        .filter(F.col("mark").isNull() | (F.round("score", 6) >= F.round("mark", 6)))
        .select("query_id", "block")
    )
    return early.unionByName(_scored(asked, store, cut_lineage(rest), topn))


def _scored(asked: DataFrame, store: PostingStore, pairs: DataFrame | None, topn: int | None) -> DataFrame:
    fields, avg = store.fields, store.avg
    left, right = _met(asked, store, pairs, ["query_id", "term", "need", *[f"w_{f}" for f in fields]])
    kinds = [dict(asked.dtypes)["query_id"], store.blocks.schema["ids"].dataType.elementType.simpleString()]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.nulls(0, right["query_id"].type), "chunk_id": pa.nulls(0, left.schema.field("ids").type.value_type), "score": pa.nulls(0, pa.float64()), "matched": pa.nulls(0, pa.int64())})
        left, right = left.combine_chunks(), right.combine_chunks()
        own = left.filter(pc.is_null(left["term"])).combine_chunks()
        mine = left.filter(pc.is_valid(left["term"])).sort_by("term").combine_chunks()
        ids = own["ids"].combine_chunks().flatten()
        queries = right["query_id"].combine_chunks().dictionary_encode()
        q = queries.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        need = np.zeros(len(queries.dictionary), np.int64)
        need[q] = right["need"].to_numpy()
        of = pc.index_in(right["term"].combine_chunks(), value_set=mine["term"].combine_chunks()).to_numpy(zero_copy_only=False).astype(np.int64)
        offsets, at = _flat(mine["at"].combine_chunks())
        tile = _Tile(len(ids), {f: _flat(own[f"len_{f}"].combine_chunks())[1] for f in fields}, offsets, at, {f: _flat(mine[f"tf_{f}"].combine_chunks())[1] for f in fields}, q, of, {f: right[f"w_{f}"].to_numpy() for f in fields}, need, avg)
        if topn is not None:
            tile.keep_best(topn)
        return pa.table(tile.rows(queries.dictionary, ids), names=["query_id", "chunk_id", "score", "matched"])

    return (
        left.groupBy("tile", "block")
        .cogroup(right.groupBy("of_tile", "of_block"))
        .applyInArrow(score, f"query_id {kinds[0]}, chunk_id {kinds[1]}, score double, matched bigint")
    )


def _scored_in_place(asked: DataFrame, store: PostingStore, topn: int | None, tile_rows: int) -> DataFrame:
    """As ``_scored`` over all blocks, with the questions sent to the tasks that read the index."""
    fields, avg = store.fields, store.avg
    kinds = [dict(asked.dtypes)["query_id"], store.blocks.schema["ids"].dataType.elementType.simpleString()]
    told = asked.select("query_id", "term", "need", *[f"w_{f}" for f in fields]).toArrow().combine_chunks()
    ids, terms = (pa.array([], told[c].type) if not told.num_rows else told[c].combine_chunks() for c in ("query_id", "term"))
    ids, terms = ids.dictionary_encode(), terms.dictionary_encode()
    q, of = (x.indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in (ids, terms))
    need = np.zeros(len(ids.dictionary), np.int64)
    need[q] = told["need"].to_numpy()
    order = np.argsort(q, kind="stable")
    weights = {f: told[f"w_{f}"].to_numpy()[order] for f in fields}
    sent = asked.sparkSession.sparkContext.broadcast((ids.dictionary, terms.dictionary, q[order], of[order], need, weights))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, words, q, of, need, weights = sent.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(j).slice(i, 1).flatten() for j, name in enumerate(batch.schema.names)}
                place = pc.fill_null(pc.index_in(words, value_set=row["terms"]), -1).to_numpy(zero_copy_only=False)[of].astype(np.int64)
                offsets, at = _flat(row["ats"])
                tfs = {f: _flat(row[f"tf_{f}s"])[1] for f in fields}
                lengths = {f: row[f"len_{f}"].to_numpy() for f in fields}
                for first in range(0, len(need), tile_rows):
                    a, b = np.searchsorted(q, [first, first + tile_rows])
                    here = a + np.flatnonzero(place[a:b] >= 0)
                    if not len(here):
                        continue
                    tile = _Tile(len(row["ids"]), lengths, offsets, at, tfs, q[here] - first, place[here], {f: w[here] for f, w in weights.items()}, need[first : first + tile_rows], avg)
                    if topn is not None:
                        tile.keep_best(topn)
                    yield pa.RecordBatch.from_arrays(tile.rows(queries.slice(first, tile_rows), row["ids"]), names=["query_id", "chunk_id", "score", "matched"])

    lists = ["terms", "ats", *[f"tf_{f}s" for f in fields], "ids", *[f"len_{f}" for f in fields]]
    return store.blocks.select(*lists).mapInArrow(score, f"query_id {kinds[0]}, chunk_id {kinds[1]}, score double, matched bigint")


def matched_counts(needs: DataFrame, store: PostingStore, carried: str, key: str = "query_id", tile_rows: int = 1 << 16) -> DataFrame:
    """``(key, value, n)``: how often each value of the carried list column stands in the chunks that share ``need`` terms.

    ``needs(key, term, need)`` has distinct terms; at least one is needed. About ``tile_rows`` questions at a time are sent
    to all tasks, which read their blocks and add up the counts of all of them, so a tile costs one reading of the index and
    what is shuffled are a question's counts by task. The work still grows with the questions times the chunks that share
    their terms.
    """
    rows = needs.select(F.col(key).alias("query_id"), "term", F.greatest(F.lit(1), "need").cast("bigint").alias("need"))
    tiles = max(1, -(-rows.select("query_id").distinct().count() // tile_rows))
    asked = cut_lineage(rows.join(store.stats.select("term"), "term", "left_semi").withColumn("tile", F.pmod(F.xxhash64("query_id"), F.lit(tiles)).cast("int")))
    parts = [_counted(asked.filter(F.col("tile") == tile).drop("tile"), store, carried) for tile in range(tiles)]
    return reduce(DataFrame.unionByName, parts).withColumnRenamed("query_id", key)


def _counted(asked: DataFrame, store: PostingStore, carried: str) -> DataFrame:
    """The counts of the questions of one tile."""
    spark, kind = asked.sparkSession, store.blocks.schema[carried].dataType.elementType.elementType.simpleString()
    tile = asked.toArrow().combine_chunks()
    ids, terms = (tile[c].combine_chunks().dictionary_encode() for c in ("query_id", "term"))
    ids, terms = (x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in (ids, terms))
    q, of = (x.indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in (ids, terms))
    need = np.zeros(len(ids.dictionary), np.int64)
    need[q] = tile["need"].to_numpy()
    order = np.argsort(q, kind="stable")
    sent = spark.sparkContext.broadcast((ids.dictionary, terms.dictionary, q[order], of[order], need))
    kinds = f"query_id {dict(asked.dtypes)['query_id']}, value {kind}, n bigint"
    counts = store.blocks.select("terms", "ats", F.size("ids").alias("d"), carried).mapInArrow(lambda batches: _tile_counts(batches, sent.value, carried), kinds)
    found = cut_lineage(counts.groupBy("query_id", "value").agg(F.sum("n").alias("n")))
    sent.destroy()
    return found


def _tile_counts(batches: Iterator[pa.RecordBatch], tile: tuple, carried: str, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Counts of a tile's questions over the blocks of one task, as one list of (question, value) cells."""
    ids, words, q, of, need = tile
    known, cells, sums, held = None, np.zeros(0, np.int64), np.zeros(0, np.int64), []
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            values = row.column(3).flatten()
            flat = values.flatten()
            known = pa.array([], flat.type) if known is None else known
            fresh = pc.unique(flat)
            known = pa.concat_arrays([known, fresh.filter(pc.invert(pc.is_in(fresh, value_set=known)))])
            code = pc.index_in(flat, value_set=known).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = values.offsets.to_numpy().astype(np.int64) - values.offsets[0].as_py()
            for cell, n in _block_counts(row, words, q, of, need, ends, code):
                held.append((cell, n))
                if sum(len(c) for c, _ in held) > max(most // 4, len(cells)):
                    cells, sums, held = *_merged(cells, sums, held), []
                if len(cells) > most:
                    yield _cell_rows(ids, known, cells, sums)
                    cells, sums = cells[:0], sums[:0]
    cells, sums = _merged(cells, sums, held)
    if len(cells):
        yield _cell_rows(ids, known, cells, sums)


def _merged(cells: np.ndarray, sums: np.ndarray, more: list) -> tuple[np.ndarray, np.ndarray]:
    every, place = np.unique(np.concatenate([cells, *[c for c, _ in more]]), return_inverse=True)
    return every, np.bincount(place, np.concatenate([sums, *[n for _, n in more]]), len(every)).astype(np.int64)


def _cell_rows(ids: pa.Array, known: pa.Array, cells: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([ids.take(pa.array(cells >> 32)), known.take(pa.array(cells & 0xFFFFFFFF)), pa.array(sums)], names=["query_id", "value", "n"])


def _block_counts(row: pa.RecordBatch, words: pa.Array, q: np.ndarray, of: np.ndarray, need: np.ndarray, ends: np.ndarray, code: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Cells ``question << 32 | value`` and their counts in one block, some questions at a time."""
    d = row.column(2)[0].as_py()
    place = pc.fill_null(pc.index_in(words, value_set=row.column(0).flatten()), -1).to_numpy(zero_copy_only=False)[of]
    here = np.flatnonzero(place >= 0)
    if not len(here) or not d:
        return
    lists = row.column(1).flatten()
    offsets = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
    at = lists.flatten().to_numpy()
    q, place = q[here], place[here].astype(np.int64)
    begin, size = offsets[place], np.diff(offsets)[place]
    first = np.flatnonzero(np.diff(q, prepend=-1))  # questions stand together
    asked = np.diff(np.append(first, len(q)))
    load = np.add.reduceat(size, first)
    step = np.maximum(np.cumsum(load) // PAIRS, np.arange(len(first)) * d // PAIRS)
    cuts = np.append(np.flatnonzero(np.diff(step, prepend=-1)), len(first))
    heads = np.append(first, len(q))
    for a, b in zip(cuts[:-1], cuts[1:]):
        x, y = heads[a], heads[b]
        s = size[x:y]
        past = np.cumsum(s)
        where = np.repeat(begin[x:y] - (past - s), s) + np.arange(past[-1])
        local = np.repeat(np.arange(b - a), asked[a:b])
        matched = np.bincount(np.repeat(local, s) * d + at[where], minlength=(b - a) * d)
        hits = np.flatnonzero(matched >= np.repeat(need[q[first[a:b]]], d))
        c, of_hit = hits % d, q[first[a:b]][hits // d]
        s = ends[c + 1] - ends[c]
        past = np.cumsum(s)
        where = np.repeat(ends[c] - (past - s), s) + np.arange(past[-1] if len(past) else 0)
        yield np.unique((np.repeat(of_hit, s) << 32) | code[where], return_counts=True)
