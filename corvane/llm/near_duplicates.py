"""Near-duplicate documents by fast similarity sketches of word shingles, banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm import blocks
from corvane.llm.linking import link_items
from corvane.session import cut_lineage

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(part: blocks.Texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and where each text's begin.

    A-Z are lower-cased. A shingle is ``width`` consecutive words, or the whole sequence where there are fewer.
    """
    lowered = blocks.Texts(part.first, part.last, LOWER[part.data], part.bounds)
    starts, ends, first = lowered.words()
    words = blocks.span_hashes(lowered.data, starts, ends)
    runs = blocks.window_hashes(words, width)
    sets = []
    for i in range(len(part)):
        low, high = first[i], first[i + 1]
        if high - low >= width:
            sets.append(np.unique(runs[low : high - width + 1]))
        elif high > low:
            sets.append(blocks.window_hashes(words[low:high], int(high - low), seed=1))
        else:
            sets.append(np.zeros(0, np.uint64))
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), bounds


def fast_similarity_sketch(values: np.ndarray, bounds: np.ndarray, bins: int) -> np.ndarray:
    """One row of ``bins`` coordinates per set.

    In round i every element hashes to a bin and a value; a bin keeps the smallest value of the first round that
    reaches it. The rounds from ``bins`` on place all elements in bin ``i - bins``, so every bin of a set that is not
    empty is filled after ``2 * bins`` rounds at the latest; a set leaves as soon as its bins are full. Two sets agree
    in a coordinate with the probability of their Jaccard similarity, and the count of agreements concentrates as
    that of independent draws does. Rows of empty sets stay at the largest value.
    """
    sizes = np.diff(bounds)
    n = len(sizes)
    sketch = np.full(n * bins, NONE, dtype=np.uint64)
    owner = np.repeat(np.arange(n), sizes)
    open_values, open_owner = values, owner
    left = np.ones(n, dtype=bool)  # sets whose bins are not all full
    for turn in range(2 * bins):
        if not len(open_values):
            break
        hashed = blocks.mix(open_values, 1000 + turn)
        place = (hashed >> np.uint64(40)).astype(np.int64) % bins if turn < bins else np.full(len(hashed), turn - bins)
        value = (np.uint64(turn) << np.uint64(40)) | (hashed & np.uint64((1 << 40) - 1))
        np.minimum.at(sketch, open_owner * bins + place, value)
        rest = np.flatnonzero(left)
        left[rest] = (sketch.reshape(n, bins)[rest] == NONE).any(axis=1)
        more = left[open_owner]
        open_values, open_owner = open_values[more], open_owner[more]
    return sketch.reshape(n, bins)


def band_keys(sketch: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key for each band of ``rows`` coordinates; bands have keys of their own."""
    n, bins = sketch.shape
    bands = bins // rows
    out = np.repeat(np.arange(bands, dtype=np.uint64)[None, :], n, axis=0)
    for r in range(rows):
        out = blocks.mix(out ^ sketch[:, r : bands * rows : rows], 31)
    return out


def set_keys(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One key per set: equal sets have equal keys."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(blocks.mix(values, 77), dtype=np.uint64)])
    return blocks.mix(total[bounds[1:]] - total[bounds[:-1]], 78)


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 75, bands: int = 40, rows: int = 5
) -> DataFrame:
    """One row per document: ``key, n_shingles, component_id, kept``.

    Documents are linked if their shingle sets share at least ``percent`` of their union; components are the chains of
    links, named by their smallest key, which is the one kept. Sketches of ``bands * rows`` coordinates choose the
    candidates (at a similarity of 0.75 one pair in 50 000 is missed), full sets decide. Equal sets are one item from
    the start, so copies cost one row each. Texts without words, null ones too, have an empty set and stand alone.
    Rows with a repeated key get one result each; a null key is kept if it stands alone. An empty table gives no rows.
    """
    source = blocks.keyed(docs, key, text)
    kind = dict(source.dtypes)["key"]

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks.texts(batch.column(1)):
                values, bounds = shingle_sets(part, width)
                keys = band_keys(fast_similarity_sketch(values, bounds, bands * rows), rows)
                sizes, ids = np.diff(bounds), blocks.signed(set_keys(values, bounds))
                new = np.zeros(len(part), dtype=bool)  # copies within a block bring their bands once
                new[np.unique(ids, return_index=True)[1]] = True
                new &= sizes > 0
                cuts = np.concatenate([[0], np.cumsum(np.where(new, bands, 0))])
                items = pa.array(ids, mask=sizes == 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, len(part)),
                        items,
                        pa.array(sizes),
                        blocks.ragged(blocks.signed(keys[new].ravel()), cuts, pa.int64()),
                        batch.column(2).slice(part.first, len(part)),
                    ],
                    names=["key", "item", "size", "bands", "t"],
                )

    sketches = cut_lineage(source.mapInArrow(sketched, f"key {kind}, item bigint, size bigint, bands array<bigint>, t bigint"))
    lowest = cut_lineage(sketches.filter("item is not null").groupBy("item").agg(F.min("key").alias("low"), F.min("t").alias("t")))

    def shingles(part: blocks.Texts) -> tuple[np.ndarray, np.ndarray]:
        return shingle_sets(part, width)

    def texts_of(wanted: DataFrame) -> DataFrame:
        places = lowest.join(wanted, "item").select(F.col("low").alias("key"), "t", "item")

        def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Rows whose text is the item's: where keys repeat, other texts come along."""
            for batch in batches:
                items = batch.column(0).to_numpy()
                same = [items[p.first : p.last] == blocks.signed(set_keys(*shingles(p))) for p in blocks.texts(batch.column(1))]
                yield batch.filter(pa.array(np.concatenate(same) if same else np.zeros(0, bool)))

        texts = blocks.join_named(source, places, lambda named: named).select("item", "text")
        return texts.mapInArrow(own, "item bigint, text string").dropDuplicates(["item"])

    groups = link_items(sketches.filter("item is not null").select("item", "size", "bands"), texts_of, shingles, percent)
    named = lowest.join(groups, "item", "left").withColumn("group", F.coalesce("group", "item"))
    heads = named.groupBy("group").agg(F.min("low").alias("component_id"))
    owners = cut_lineage(named.join(heads, "group").select("item", "component_id"))
    out = sketches.select("key", "item", F.col("size").alias("n_shingles")).join(owners, "item", "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "key"))
    return out.select(F.col("key").alias(key), "n_shingles", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))
