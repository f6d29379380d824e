"""Texts of an Arrow batch as byte blocks: words, and 64-bit hashes of spans, computed for a whole block at once.

A block holds as many consecutive texts as fit in ``BLOCK_BYTES``, and one text at least, so memory follows the block and
not the batch. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 20
SPACES = np.zeros(256, dtype=bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit mixing of each value."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def unit(x: np.ndarray) -> np.ndarray:
    """Uniform doubles in [0, 1) from 64-bit hashes."""
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd base and of its inverse modulo 2^64."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            both.append(np.cumprod(p, dtype=np.uint64))
        have = _POWERS[base] = (both[0], both[1])
        if size > 4 * BLOCK_BYTES:  # one huge text must not pin memory for the rest of the task
            del _POWERS[base]
    return have


def _spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    power, inverse = _powers(len(values) + 1, base)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * power[: len(values)], out=total[1:])
    return (total[ends] - total[starts]) * inverse[starts]


def span_hasher(data: np.ndarray, seed: int = 0) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """:func:`span_hashes` for many lists of spans of the same bytes, which are added up once for all of them."""
    base = 0x9E3779B97F4A7C13 + 16 * seed
    power, inverse = _powers(len(data) + 1, base)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(mix(np.arange(256, dtype=np.uint64), 101 + seed)[data] * power[: len(data)], out=total[1:])
    return lambda starts, ends: mix((total[ends] - total[starts]) * inverse[starts], seed)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of the bytes of each span."""
    return span_hasher(data, seed)(starts, ends)


def window_hashes(hashes: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``length`` consecutive hashes, by the run's first place."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    first = np.arange(n)
    return mix(_spans(hashes, first, first + length, 0xD1342543DE82EF97 + 16 * seed), 7 + seed)


class Texts:
    """Consecutive texts of a batch: rows ``first`` to ``last``, their bytes and where each one begins and ends."""

    def __init__(self, first: int, last: int, data: np.ndarray, bounds: np.ndarray):
        self.first, self.last, self.data, self.bounds = first, last, data, bounds

    def __len__(self) -> int:
        return self.last - self.first

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin and end of each word ``[^\\x20\\x09-\\x0D]+``; and of each text, the place of its first word."""
        n = len(self.data)
        if n == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(self) + 1, np.int64)
        space = SPACES[self.data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[self.bounds] = True
        before = edge[:n].copy()
        before[1:] |= space[:-1]
        after = edge[1:].copy()
        after[:-1] |= space[1:]
        starts = np.flatnonzero(before & ~space)
        ends = np.flatnonzero(after & ~space) + 1
        return starts, ends, np.searchsorted(starts, self.bounds)


def texts(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Texts]:
    """The texts of a column in blocks of about ``limit`` bytes."""
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    _, offsets, raw = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    bounds = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield Texts(first, last, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first])
        first = last


def ragged(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Values as one list per text, cut at ``bounds``."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32), pa.int32()), pa.array(values, kind))


def signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def row_key(key: str, text: str) -> Column:
    """A key of a row that is never null: rows have the same one if key and text are equal. Null keys come last."""
    return F.struct(F.col(key).isNull().alias("no_id"), F.col(key).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("t"))


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key, text`` and ``t``, which names the text of a row without key."""
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return source.withColumn("t", F.when(F.col("key").isNull(), F.xxhash64(F.coalesce(F.col("text"), F.lit("")))))


def join_named(source: DataFrame, places: DataFrame, named) -> DataFrame:
    """:func:`join_texts` of a :func:`keyed` table by key, and by ``t`` where ``places`` has no key.

    ``named(places)`` gives one row per ``key``, and has the other columns that are wanted.
    """
    by_key = named(places.filter("key is not null").drop("t"))
    by_text = named(places.filter("key is null").select(F.col("t").alias("key"), *[c for c in places.columns if c not in ("key", "t")]))
    no_key = source.filter("key is null").select(F.col("t").alias("key"), "text")
    return join_texts(source, by_key, "key").drop("key").unionByName(join_texts(no_key, by_text, "key").drop("key"))


def join_texts(docs: DataFrame, named: DataFrame, key: str) -> DataFrame:
    """``docs`` with ``key`` and ``text`` joined to ``named`` by ``key``; the texts cross the shuffle compressed.

    A text of prose takes about two thirds of the bytes that Spark's own block compression leaves. Null texts come back
    empty.
    """
    kind = dict(docs.dtypes)[key]
    rest = [f for f in named.schema.fields if f.name != key]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=1)
        for batch in batches:
            for part in texts(batch.column(1)):
                raw = part.data.tobytes()
                blobs = [codec.compress(raw[a:b], asbytes=True) for a, b in zip(part.bounds[:-1], part.bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first, len(part)), pa.array(blobs, pa.binary()), pa.array(np.diff(part.bounds))], names=[key, "blob", "bytes"]
                )

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            cuts = np.unique(np.cumsum(sizes) // BLOCK_BYTES, return_index=True)[1].tolist() + [len(sizes)]
            for first, last in zip(cuts[:-1], cuts[1:]):
                part = batch.slice(first, last - first)
                raw = [codec.decompress(b.as_buffer(), int(n), asbytes=True) for b, n in zip(part.column(0), sizes[first:last])]
                yield pa.RecordBatch.from_arrays([pa.array(raw, pa.binary()).cast(pa.string()), *part.columns[2:]], names=["text", *part.schema.names[2:]])

    packed = docs.select(key, "text").mapInArrow(pack, f"{key} {kind}, blob binary, bytes bigint")
    joined = packed.join(named, key).select("blob", "bytes", key, *[f.name for f in rest])
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rest)
    return joined.mapInArrow(unpack, f"text string, {key} {kind}" + (f", {fields}" if fields else ""))
