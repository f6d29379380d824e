"""Sharding by histogram sort: count bytes below candidate boundaries, refine the candidates, exchange the rows once."""

from __future__ import annotations

import bisect
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.session import cut_lineage

DIGIT = 12  # bits by which a round refines a key
PARTS = ("_h", "_k", "_r")


def _digit(part: Column, turn: int) -> Column:
    """The ``turn``-th twelve bits of a signed long, so that digits sort as the unsigned value does."""
    shift = 64 - DIGIT * (turn + 1)
    value = F.shiftrightunsigned(part, shift) if shift >= 0 else part
    mask = (1 << DIGIT) - 1 if shift >= 0 else (1 << (DIGIT + shift)) - 1
    return value.bitwiseAND(F.lit(mask)).cast("int")


def _path(levels: int) -> Column:
    """The first ``levels`` digits of a row's key as one array."""
    turns = math.ceil(64 / DIGIT)
    return F.array(*[_digit(F.col(PARTS[i // turns]), i % turns) for i in range(levels)])


def splitters(keys: DataFrame, pieces: int, tolerance: float) -> list[tuple[int, ...]]:
    """``pieces - 1`` ascending boundaries of keys ``(_h, _k, _r, size)`` between pieces of near equal bytes.

    A boundary is a sequence of digits; a row lies below it if its digits sort before it. The first round counts the
    bytes of all 4096 values of the first digit, each later round those of the next digit, only within the cells
    that hold more than one row and a boundary still further than ``tolerance`` pieces from its place. A round brings
    4096 sums to the driver at most for each open boundary. The last key part is unique, so even equal rows can be parted.
    """
    total = keys.agg(F.sum("size")).first()[0] or 0
    if not total:
        return [(0,)] * (pieces - 1)
    wanted = [total * i / pieces for i in range(1, pieces)]
    slack = max(1.0, tolerance * total / pieces)
    found: dict[int, tuple[int, ...]] = {}
    cells: dict[tuple[int, ...], tuple[float, list[int]]] = {(): (0, list(range(len(wanted))))}
    depth = 0
    most = len(PARTS) * math.ceil(64 / DIGIT)
    while cells and depth < most:
        rows = keys
        if depth:
            # the open cells are one for each boundary at most, so the list is short
            inside = [F.struct(*[F.lit(d) for d in cell]) for cell in cells]
            names = F.struct(*[_path(depth)[i] for i in range(depth)])
            rows = keys.filter(names.isin(*inside))
        sums: dict[tuple[int, ...], dict[int, tuple[int, int]]] = {}
        grouped = rows.groupBy(_path(depth + 1).alias("path")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
        for path, size, n in grouped.collect():
            sums.setdefault(tuple(path[:-1]), {})[path[-1]] = (size, n)
        further: dict[tuple[int, ...], tuple[float, list[int]]] = {}
        for cell, (below, open_) in cells.items():
            digits = sorted(sums.get(cell, {}).items())
            edges, heights, counts = [], [], []
            for digit, (size, n) in digits:
                edges.append(digit)
                heights.append(below)
                counts.append(n)
                below += size
            for i in open_:
                at = bisect.bisect_right(heights, wanted[i]) - 1
                at = max(at, 0)
                end = heights[at + 1] if at + 1 < len(heights) else below
                alone = counts[at] == 1 or depth + 1 == most  # one row: no boundary is nearer than its two sides
                if wanted[i] - heights[at] <= max(slack, alone * (end - wanted[i])):
                    found[i] = (*cell, edges[at])
                elif alone or end - wanted[i] <= slack:
                    found[i] = (*cell, edges[at] + 1)
                else:
                    low, held = further.setdefault((*cell, edges[at]), (heights[at], []))
                    held.append(i)
        cells, depth = further, depth + 1
    return [found[i] for i in range(len(wanted))]


def _at_or_above(boundary: tuple[int, ...]) -> Column:
    """Whether a row's digits are not before the boundary's."""
    digits = _path(len(boundary))
    out = F.lit(True)
    for i in range(len(boundary) - 1, -1, -1):
        out = (digits[i] > boundary[i]) | ((digits[i] == boundary[i]) & out)
    return out


def shard_by_bytes(
    docs: DataFrame,
    shards: int = 24,
    key: str = "doc_id",
    text: str = "text",
    overhead: int = 8,
    tolerance: float = 0.002,
    piece_rows: int = 1_000_000,
) -> DataFrame:
    """All rows of ``docs`` with ``shard`` and ``slot``; the shards hold near equal bytes.

    A document weighs the UTF-8 bytes of its text (null: none) plus ``overhead``. Rows sort by a hash of the text, then
    by a hash of the key, then by a row number, so equal texts stand together and are parted only where a boundary must
    fall among them. Boundaries come from :func:`splitters`. Each shard is made of pieces of about ``piece_rows`` rows,
    also with exact boundaries; rows meet once, by piece, where they are sorted and numbered; what lies before a piece
    is a sum over one row per piece. Slots are gapless from 0 within a shard. The row number only parts rows that are
    equal in text and key; ``docs`` must come in the same partitions when read again, as a table does. An empty table
    gives no rows.
    """
    weight = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + overhead
    hashes = [F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_h"), F.xxhash64(F.col(key)).alias("_k")]
    rows = docs.select("*", *hashes, F.monotonically_increasing_id().alias("_r"), weight.alias("_size"))
    keys = cut_lineage(rows.select(*PARTS, F.col("_size").alias("size")))
    per_shard = max(1, math.ceil(keys.count() / shards / piece_rows))
    cuts = splitters(keys, shards * per_shard, tolerance)

    def piece() -> Column:
        return sum((_at_or_above(b).cast("int") for b in cuts), F.lit(0)).cast("int")

    counts = keys.groupBy(piece().alias("_piece")).agg(F.count(F.lit(1)).alias("n"))
    shard = F.floor(F.col("_piece") / per_shard).cast("int")
    before = Window.partitionBy(shard).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut_lineage(counts.select("_piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before")))
    inside = Window.partitionBy("_piece").orderBy(*[F.col(p).bitwiseXOR(F.lit(-(1 << 63))) for p in PARTS])  # unsigned order
    placed = rows.withColumn("_piece", piece()).withColumn("_n", F.row_number().over(inside))
    return (
        placed.join(offsets, "_piece")
        .withColumns({"shard": shard, "slot": (F.col("_before") + F.col("_n") - 1).cast("bigint")})
        .drop("_piece", "_n", "_before", "_size", *PARTS)
    )
