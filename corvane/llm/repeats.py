"""Substring dedup by level-wise doubling: windows repeated at one length alone go on to twice that length."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm import blocks
from corvane.session import cut_lineage

TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
ANCHOR = pa.struct([("pos", pa.int32()), ("h", pa.int64())])


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each run of ``width`` values."""
    reach = 1
    while reach * 2 <= width:
        values = pick(values[:-reach], values[reach:])
        reach *= 2
    return pick(values[: len(values) - (width - reach)], values[width - reach :]) if width > reach else values


class Words:
    """The words of a block with their hashes, and the windows that lie within one text."""

    def __init__(self, part: blocks.Texts, window: int):
        self.starts, self.ends, self.first = part.words()
        self.hashes = blocks.span_hashes(part.data, self.starts, self.ends)
        self.owner = np.repeat(np.arange(len(part)), np.diff(self.first))
        self.window = window
        n = max(0, len(self.hashes) - window + 1)
        self.whole = self.owner[:n] == self.owner[window - 1 : window - 1 + n]

    def smallest(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The hash of each run of ``length`` words, and of each window the smallest one of its runs."""
        runs = blocks.window_hashes(self.hashes, length)
        if not len(self.whole):
            return runs, runs[:0]
        return runs, _slide(runs, self.window - length + 1, np.minimum)

    def anchors(self, length: int, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the runs that are the smallest in a window still alive."""
        runs, low = self.smallest(length)
        if not alive.any():
            return np.zeros(0, np.int64), runs[:0]
        width = self.window - length + 1
        edge = np.zeros(width - 1, np.uint64)
        reached = _slide(np.concatenate([edge, np.where(alive, low, np.uint64(0)), edge]), width, np.maximum)
        places = np.flatnonzero((reached == runs) & (reached != 0))
        return places, runs[places]

    def still_alive(self, length: int, repeated: np.ndarray) -> np.ndarray:
        """Windows whose smallest run of ``length`` words stands at one of the ``repeated`` places."""
        runs, low = self.smallest(length)
        if not len(low):
            return self.whole
        marked = np.full(len(runs), TOP, dtype=np.uint64)
        marked[repeated] = runs[repeated]
        return self.whole & (_slide(marked, self.window - length + 1, np.minimum) == low)

    def of_texts(self, lists: pa.Array) -> np.ndarray:
        """Places in the block of lists of places within each text."""
        bounds = lists.offsets.to_numpy()
        counts = np.diff(bounds)
        values = lists.values.to_numpy()[bounds[0] : bounds[-1]]
        return values.astype(np.int64) + np.repeat(self.first[:-1], counts)


def _lists(words: Words, places: np.ndarray, values: pa.Array, n: int) -> pa.Array:
    """One list per text of the values at ascending places."""
    counts = np.bincount(words.owner[places], minlength=n)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)


def levels(window: int, first: int) -> list[int]:
    """Lengths that double up to the window: 18, 35 for a window of 35 and a first length of at most 18."""
    out = [window, (window + 1) // 2]
    while out[-1] > first and out[-1] > 1:
        out.append((out[-1] + 1) // 2)
    return out[::-1]


def _repeated(rows: DataFrame, by: list[str]) -> DataFrame:
    """The rows ``(d, pos, *by)`` whose ``by`` occurs twice or more, as one list of places per text.

    The repeated values are written first, so that the join meets two plain sides and can split a frequent value.
    """
    counts = cut_lineage(rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*by))
    return rows.join(counts, by, "left_semi").groupBy("d").agg(F.collect_set("pos").alias("places"))


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 35, first: int = 18) -> DataFrame:
    """One row per document: ``key, n_words, n_removed, kept_sha256``.

    A word goes if a window of ``window`` words that covers it also starts anywhere else, in any document; words are
    ``[^\\x20\\x09-\\x0D]+``, unchanged, and the digest is of the kept words joined by one space.

    A window can repeat only if the run of half its length that has the smallest hash within it repeats too, as equal
    windows choose equal runs. So the first level gathers the chosen runs alone (one word in eight), later levels the
    chosen runs of windows that are still alive, and the last one whole windows, by 96 bits of hash. The texts that
    still hold a live window are carried to the next level; when none is left, the loop ends. Equal texts are
    one text after the first level, and lose all words if they have a window at all.

    Null and empty texts have no words; shorter ones lose none. Rows with equal keys are judged each by itself. An
    empty table gives no rows.
    """
    source = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("d"))
    kind = dict(source.dtypes)["key"]
    lengths = levels(window, first)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks.texts(batch.column(1)):
                words = Words(part, window)
                places, hashes = words.anchors(lengths[0], words.whole)
                pos = places - words.first[words.owner[places]]
                found = pa.StructArray.from_arrays([pa.array(pos, pa.int32()), pa.array(blocks.signed(hashes))], fields=list(ANCHOR))
                raw = part.data.tobytes()
                shas = [hashlib.sha256(b" ".join(raw[a:b].split())).hexdigest() for a, b in zip(part.bounds[:-1], part.bounds[1:])]
                cut = slice(part.first, part.last)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[cut], batch.column(2)[cut], pa.array(np.diff(words.first)), pa.array(shas), _lists(words, places, found, len(part))],
                    names=["key", "d", "n_words", "sha", "anchors"],
                )

    every = cut_lineage(source.mapInArrow(whole, f"key {kind}, d bigint, n_words bigint, sha string, anchors array<struct<pos int, h bigint>>"))
    places = _repeated(every.select("d", F.inline("anchors")), ["h"])
    # equal texts become one before they move
    live = source.select("d", "text").groupBy("d").agg(F.first("text").alias("text")).join(places, "d")
    live = live.withColumn("alive", F.lit(None).cast("array<int>"))

    for length, longer in zip(lengths[:-1], lengths[1:]):

        def narrowed(batches: Iterator[pa.RecordBatch], length=length) -> Iterator[pa.RecordBatch]:
            """Drop the windows whose run of ``length`` words did not repeat."""
            for batch in batches:
                for part in blocks.texts(batch.column(1)):
                    words = Words(part, window)
                    cut = slice(part.first, part.last)
                    alive = words.still_alive(length, words.of_texts(batch.column(2)[cut]))
                    earlier = batch.column(3)[cut]
                    if earlier.null_count < len(part):
                        before = np.zeros(len(alive), dtype=bool)
                        before[words.of_texts(earlier)] = True
                        alive = alive & before
                    at = np.flatnonzero(alive)
                    pos = pa.array(at - words.first[words.owner[at]], pa.int32())
                    lists = _lists(words, at, pos, len(part))
                    left = np.flatnonzero(np.diff(lists.offsets.to_numpy()))
                    out = pa.RecordBatch.from_arrays([batch.column(0)[cut], batch.column(1)[cut], lists], names=["d", "text", "alive"])
                    yield out.take(pa.array(left))

        live = cut_lineage(live.select("d", "text", "places", "alive").mapInArrow(narrowed, "d bigint, text string, alive array<int>"))
        last = longer == window

        def gathered(batches: Iterator[pa.RecordBatch], length=longer, last=last) -> Iterator[pa.RecordBatch]:
            """The hashes of live windows, or of their chosen runs."""
            for batch in batches:
                for part in blocks.texts(batch.column(1)):
                    words = Words(part, window)
                    at = words.of_texts(batch.column(2)[part.first : part.last])
                    ids = batch.column(0).to_numpy()[part.first : part.last]
                    if last:
                        h = blocks.window_hashes(words.hashes, window)[at]
                        g = (blocks.window_hashes(words.hashes, window, seed=1)[at] >> np.uint64(33)).astype(np.int32)
                    else:
                        alive = np.zeros(len(words.whole), dtype=bool)
                        alive[at] = True
                        at, h = words.anchors(length, alive)
                        g = np.zeros(len(at), np.int32)
                    owner = words.owner[at]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[owner]), pa.array((at - words.first[owner]).astype(np.int32)), pa.array(blocks.signed(h)), pa.array(g)],
                        names=["d", "pos", "h", "g"],
                    )

        rows = live.select("d", "text", "alive").mapInArrow(gathered, "d bigint, pos int, h bigint, g int")
        live = live.join(_repeated(rows, ["h", "g"]), "d")

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks.texts(batch.column(1)):
                words = Words(part, window)
                cover = np.zeros(len(words.hashes) + 1, dtype=np.int64)
                at = words.of_texts(batch.column(2)[part.first : part.last])
                np.add.at(cover, at, 1)
                np.add.at(cover, at + window, -1)
                kept = np.cumsum(cover[:-1]) == 0
                raw = part.data.tobytes()
                shas = []
                for i in range(len(part)):
                    own = raw[part.bounds[i] : part.bounds[i + 1]].split()
                    shas.append(hashlib.sha256(b" ".join(compress(own, kept[words.first[i] : words.first[i + 1]]))).hexdigest())
                gone = np.bincount(words.owner[~kept], minlength=len(part))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part.first : part.last], pa.array(gone.astype(np.int64)), pa.array(shas)], names=["d", "gone", "left_sha"]
                )

    cuts = live.select("d", "text", "places").mapInArrow(removed, "d bigint, gone bigint, left_sha string")
    known = every.groupBy("d").agg(F.count(F.lit(1)).alias("copies")).join(cuts, "d", "left")
    known = cut_lineage(known.filter("copies > 1 or gone is not null"))
    out = every.select("key", "d", "n_words", "sha").join(known, "d", "left")
    copied = (F.col("copies") > 1) & (F.col("n_words") >= window)
    return out.select(
        F.col("key").alias(key),
        "n_words",
        F.when(copied, F.col("n_words")).otherwise(F.coalesce("gone", F.lit(0).cast("bigint"))).alias("n_removed"),
        F.when(copied, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("left_sha", "sha")).alias("kept_sha256"),
    )
