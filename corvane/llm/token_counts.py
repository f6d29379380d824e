"""Edit-aware token counts: a tree of pre-token sums per document, re-encoded only where edits touch it."""

from __future__ import annotations

import base64
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
AHEAD = 2  # characters after a pre-token's end that may have decided where it ends
BUCKET = 64  # pre-tokens under one leaf of the tree when it is built
TREE = "n_leaves array<int>, leaf_chars array<int>, leaf_tokens array<int>, sum_chars array<int>, sum_tokens array<int>"


class _Known(dict):
    """Token counts that are worked out when they are first asked for; ``most`` of them are remembered."""

    def __init__(self, encoding, most: int):
        super().__init__()
        self.encoding, self.most = encoding, most

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.most:
            self.clear()
        self[piece] = n = len(self.encoding.encode_ordinary(piece))
        return n


class Counter:
    """Token counts of pre-tokens; remembers up to ``most`` of them."""

    def __init__(self, raw: bytes, most: int = 1_000_000):
        import regex
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines()) if a}
        self.encoding = tiktoken.Encoding("pieces", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
        self.pattern, self.known = regex.compile(PATTERN), _Known(self.encoding, most)

    def counts(self, pieces: list[str]) -> list[int]:
        return list(map(self.known.__getitem__, pieces))


class SegmentTree:
    """Sums of characters and tokens over buckets of pre-tokens, as a complete binary tree in heap order.

    ``chars[1]`` and ``tokens[1]`` are the sums over the document; node i has the children 2i and 2i + 1, and the
    second half of the arrays holds the buckets. An edit changes the leaves of some buckets and the sums on their paths.
    """

    def __init__(self, n_leaves, leaf_chars, leaf_tokens, sum_chars=None, sum_tokens=None):
        cuts = [0, *accumulate(n_leaves)]
        self.leaf_chars = [list(leaf_chars[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
        self.leaf_tokens = [list(leaf_tokens[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
        self.width = len(n_leaves)
        self.chars, self.tokens = list(sum_chars or []), list(sum_tokens or [])
        if not self.chars:
            self.chars = [0] * self.width + [sum(x) for x in self.leaf_chars]
            self.tokens = [0] * self.width + [sum(x) for x in self.leaf_tokens]
            for i in range(self.width - 1, 0, -1):
                self._add(i)

    @classmethod
    def over(cls, chars: list[int], tokens: list[int]) -> SegmentTree:
        width = 1
        while width * BUCKET < len(chars):
            width *= 2
        each = -(-len(chars) // width) if chars else 0
        sizes = [min(each, max(0, len(chars) - i * each)) for i in range(width)]
        return cls(sizes, chars, tokens)

    def _add(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def find(self, at: int) -> tuple[int, int]:
        """The bucket of the character at an offset, and where the bucket begins; the last one for the end."""
        i, begin = 1, 0
        while i < self.width:
            i *= 2
            if at - begin >= self.chars[i]:
                begin += self.chars[i]
                i += 1
        return i - self.width, begin

    def replace(self, first: int, last: int, chars: list[int], tokens: list[int]) -> None:
        """Buckets ``first`` to ``last`` hold these leaves from now on, dealt evenly over them."""
        count = last - first + 1
        each = -(-len(chars) // count) if chars else 0
        touched = set()
        for k, bucket in enumerate(range(first, last + 1)):
            self.leaf_chars[bucket], self.leaf_tokens[bucket] = chars[k * each : (k + 1) * each], tokens[k * each : (k + 1) * each]
            node = bucket + self.width
            self.chars[node], self.tokens[node] = sum(self.leaf_chars[bucket]), sum(self.leaf_tokens[bucket])
            touched.add(node // 2)
        while touched and max(touched) > 0:
            for i in touched:
                self._add(i)
            touched = {i // 2 for i in touched if i > 1}

    def columns(self) -> tuple:
        flat = lambda lists: [x for part in lists for x in part]
        return [len(x) for x in self.leaf_chars], flat(self.leaf_chars), flat(self.leaf_tokens), self.chars, self.tokens


def edit(text: str, tree: SegmentTree, at: int, cut: int, put: str, counter: Counter) -> tuple[str, int]:
    """The text with ``cut`` characters at offset ``at`` replaced by ``put``, and how many pre-tokens were encoded.

    Pre-tokens are matched from left to right, and where one ends depends on :data:`AHEAD` characters behind it at
    most. So matching starts again at the pre-token that holds the character ``AHEAD`` before the edit, and ends where
    it meets the begin of an old pre-token behind the edit; from there all matches are the old ones.
    """
    at = min(max(at, 0), len(text))
    cut = min(max(cut, 0), len(text) - at)
    after = text[:at] + put + text[at + cut :]
    moved = len(put) - cut
    first, begin = tree.find(max(0, at - AHEAD))
    chars, tokens = tree.leaf_chars[first], tree.leaf_tokens[first]
    ends = list(accumulate(chars, initial=begin))
    keep = max(0, bisect_right(ends, max(0, at - AHEAD)) - 1)
    keep = min(keep, len(chars))
    start = ends[keep]
    # the old begins behind the edit, read on bucket by bucket as far as the matching goes
    last, old, upto = first, set(ends[keep:]), ends[-1]
    pieces: list[str] = []
    place = start
    for match in counter.pattern.finditer(after, start):
        while last + 1 < tree.width and upto <= match.start() - moved:
            last += 1
            more = list(accumulate(tree.leaf_chars[last], initial=upto))
            old.update(more)
            upto = more[-1]
        if match.start() >= at + len(put) and match.start() - moved in old and match.start() - moved >= at + cut:
            break
        pieces.append(match.group())
        place = match.end()
    else:
        place = len(after)
    while last + 1 < tree.width and upto < place - moved:
        last += 1
        upto += sum(tree.leaf_chars[last])
    # the leaves of the touched buckets that lie behind the place where old and new meet
    tail_chars: list[int] = []
    tail_tokens: list[int] = []
    spot = begin
    for bucket in range(first, last + 1):
        for c, t in zip(tree.leaf_chars[bucket], tree.leaf_tokens[bucket]):
            if spot >= place - moved and spot >= at + cut and spot >= start:
                tail_chars.append(c)
                tail_tokens.append(t)
            spot += c
    new_chars, new_tokens = [len(p) for p in pieces], counter.counts(pieces)
    tree.replace(first, last, chars[:keep] + new_chars + tail_chars, tokens[:keep] + new_tokens + tail_tokens)
    return after, len(pieces)


def build_trees(docs: DataFrame, key: str = "doc_id", text: str = "text", ranks: str = RANKS) -> DataFrame:
    """One row per document: ``key, text`` and its tree (see :class:`SegmentTree`).

    The driver reads the rank file and sends it to the workers. Null text is empty. An empty table gives no rows.
    """
    raw = open(ranks, "rb").read()
    source = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = dict(source.dtypes)["key"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(raw)
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                trees = []
                for body in part.column(1).to_pylist():
                    pieces = counter.pattern.findall(body)
                    trees.append(SegmentTree.over([len(p) for p in pieces], counter.counts(pieces)).columns())
                yield pa.RecordBatch.from_arrays([*part.columns, *_arrays(trees)], names=["key", "text", *[f.split()[0] for f in TREE.split(", ")]])

    return source.mapInArrow(build, f"key {kind}, text string, {TREE}").withColumnRenamed("key", key)


def _arrays(trees: list[tuple]) -> list[pa.Array]:
    return [_list_array([t[i] for t in trees]) for i in range(5)]


def _list_array(lists: list[list[int]]) -> pa.Array:
    ends = np.fromiter(accumulate(map(len, lists), initial=0), np.int32, len(lists) + 1)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.fromiter(chain.from_iterable(lists), np.int32, int(ends[-1]))))


def _lists(column: pa.ListArray) -> list[list[int]]:
    """The lists of a column without nulls; read in one go, as ``to_pylist`` takes each number by itself."""
    ends = column.offsets.to_numpy().tolist()
    values = column.values.slice(ends[0], ends[-1] - ends[0]).to_numpy().tolist()
    return [values[a - ends[0] : b - ends[0]] for a, b in zip(ends[:-1], ends[1:])]


def gather_edits(edits: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, edits)`` from rows ``key, seq, at, cut, put``: the edits of a document in order of ``seq``."""
    rows = F.sort_array(F.collect_list(F.struct("seq", "at", "cut", "put")))
    return edits.groupBy(key).agg(F.transform(rows, lambda e: F.struct(e["at"].alias("at"), e["cut"].alias("cut"), e["put"].alias("put"))).alias("edits"))


def apply_edits(trees: DataFrame, key: str = "doc_id", ranks: str = RANKS) -> DataFrame:
    """Trees after the ``edits`` (an array of ``at, cut, put``) that stand in a column of each row.

    One row per input row: ``key, text``, the new tree, ``tokens_before, tokens_after, leaves_before, leaves_after,
    encoded_leaves``. Edits apply one after the other, offsets count characters of the text as it is by then; offsets
    beyond the text are drawn to its end, a null ``put`` is empty, null ``at`` or ``cut`` is 0, and null ``edits`` are none.
    """
    raw = open(ranks, "rb").read()
    kind = dict(trees.dtypes)[key]
    names = [f.split()[0] for f in TREE.split(", ")]
    source = trees.select(F.col(key).alias("key"), "text", *names, "edits")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(raw)
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                texts, after, counts = [], [], []
                columns = [part.column(1).to_pylist(), *map(_lists, part.columns[2:7]), part.column(7).to_pylist()]
                for row in zip(*columns):
                    text, tree = row[0], SegmentTree(*row[1:6])
                    before = (tree.tokens[1], sum(row[1]))
                    encoded = 0
                    for e in row[6] or []:
                        text, n = edit(text, tree, e["at"] or 0, e["cut"] or 0, e["put"] or "", counter)
                        encoded += n
                    texts.append(text)
                    after.append(tree.columns())
                    counts.append((before[0], tree.tokens[1], before[1], sum(after[-1][0]), encoded))
                longs = [pa.array([c[i] for c in counts], pa.int64()) for i in range(5)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(texts, pa.string()), *_arrays(after), *longs],
                    names=["key", "text", *names, "tokens_before", "tokens_after", "leaves_before", "leaves_after", "encoded_leaves"],
                )

    numbers = "tokens_before bigint, tokens_after bigint, leaves_before bigint, leaves_after bigint, encoded_leaves bigint"
    return source.mapInArrow(apply, f"key {kind}, text string, {TREE}, {numbers}").withColumnRenamed("key", key)
