"""The trie of conversation prefixes, by truncation peeling from the deepest turns up.

A conversation is a row of prefix keys: the key of depth d is a 128-bit digest of the key of depth d - 1 and the turn d, so
equal keys are equal prefixes. One level at a time, the nodes that came up from below and the conversations that end here
are grouped by their last key; the group is a node and has all its sums at once; then the last key is stripped and the rows
go one level up. Levels whose prefixes all have few keys below them go up several at a time. No row ever holds members: those that end at a node are hashed in order by a stream over sorted runs.

Odd rows: null role or text count as empty; rows without conversation id take no part. Turns stand by number, null first;
turns of one number by digest. Repeated rows are turns of their own. Conversations without turns end at the root. An empty
table has no nodes. Only the named columns are read. Texts are read once and never moved; a conversation's keys are one
row, and each round rewrites what is left of them, so a conversation of t turns costs up to t squared / 2 keys.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.session import cut_lineage, shared_folder

ROOT = b""
RUN = 4096  # members of one run of the stream of ends
PATH = "array<struct<key: binary, words: int>>"
SUMS = ("n_convs", "n_children", "n_leaves", "saved")


def n_words(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))


def conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turns``: the turns of each conversation in order, each a digest and the words of its text."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    both = F.concat(F.length(empty(role)).cast("string"), F.lit(":"), empty(role), empty(text))
    turns = rows.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv"),
        F.struct(F.col(turn).alias("turn"), F.unhex(F.sha2(both, 256)).alias("digest"), n_words(empty(text)).alias("words")).alias("t"),
    )
    ordered = F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t.digest.alias("digest"), t.words.alias("words")))
    return turns.groupBy("conv").agg(ordered.alias("turns"))


def prefix_keys(convs: DataFrame) -> DataFrame:
    """``conv, path``: the prefix keys of each conversation of ``conv, turns``, each with the words of its last turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            turns = lists.flatten()
            digests, ends = turns.field(0).to_pylist(), (lists.offsets.to_numpy() - lists.offsets[0].as_py()).tolist()
            keys = []
            for a, b in zip(ends[:-1], ends[1:]):
                key = ROOT
                for digest in digests[a:b]:
                    key = hashlib.sha256(key + digest).digest()[:16]
                    keys.append(key)
            path = pa.StructArray.from_arrays([pa.array(keys, pa.binary()), turns.field(1)], ["key", "words"])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), path)], names=["conv", "path"])

    return convs.mapInArrow(run, f"conv bigint, path {PATH}")


def sorted_digests(members: DataFrame) -> DataFrame:
    """``key, ends_sha256``: SHA-256 of the members of each key, ascending and joined by commas.

    Rows ``key, conv`` are dealt by ranges, so members of a hot key stand in many tasks, which join runs of them; a key's
    runs then pass one hash in order, without being held.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []
        out: list[tuple] = []
        for batch in batches:
            for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and (k != key or len(ids) == RUN):
                    out.append((key, ids[0], ",".join(map(str, ids))))
                    ids = []
                    if len(out) == RUN:
                        yield _rows(out)
                        out = []
                key = k
                ids.append(c)
        if ids:
            out.append((key, ids[0], ",".join(map(str, ids))))
        yield _rows(out)

    def _rows(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())], names=["key", "first", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            keys, found = [], []
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k == key:
                    state.update(b"," + ids.encode())
                    continue
                if state:
                    keys.append(key)
                    found.append(state.hexdigest())
                key, state = k, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(found, pa.string())], names=["key", "ends_sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], names=["key", "ends_sha256"])

    spark = members.sparkSession
    tasks = max(members.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = members.select("key", "conv").repartitionByRange(tasks, "key", "conv").sortWithinPartitions("key", "conv")
    joined = dealt.mapInArrow(runs, "key binary, first bigint, ids string")
    return joined.repartition("key").sortWithinPartitions("key", "first").select("key", "ids").mapInArrow(digests, "key binary, ends_sha256 string")


def _merged(rows: DataFrame) -> DataFrame:
    """Contributions to nodes, one row per node."""
    return (
        rows.withColumn("key", _key(F.col("path")))
        .groupBy("key")
        .agg(F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in SUMS], F.first("path").alias("path"))
    )


def _key(path: Column) -> Column:
    return F.coalesce(F.try_element_at(path, F.lit(-1)).key, F.lit(ROOT))


NODE = f"conv_id bigint, depth int, key binary, parent binary, {', '.join(f'{c} bigint' for c in SUMS)}, path {PATH}, live boolean"


def _peel_one(rows: DataFrame, depth: int) -> DataFrame:
    """Nodes of the deepest level from all contributions to it, and those to the level above as ``live`` rows."""
    words = F.coalesce(F.try_element_at("path", F.lit(-1)).words, F.lit(0))
    parent = F.when(F.size("path") > 0, _key(F.slice("path", 1, F.greatest(F.size("path") - 1, F.lit(0)))))
    return (
        _merged(rows)
        .withColumn("n_leaves", F.greatest("n_leaves", F.lit(1)))
        .withColumn("saved", F.col("saved") + (F.col("n_convs") - 1) * words)
        .select("conv_id", F.lit(depth).alias("depth"), "key", parent.alias("parent"), *SUMS, "path", F.lit(False).alias("live"))
    )


def _peel_many(rows: DataFrame, depth: int, levels: int) -> DataFrame:
    """Nodes of ``levels`` levels from ``depth`` up, and the contributions to the level above them as ``live`` rows.

    The rows under one prefix of the level above are peeled together, one after the other from the deepest.
    """
    top = depth - levels

    def peel(table: pa.Table) -> pa.Table:
        ids, sums = table["conv_id"].to_pylist(), list(zip(*(table[c].to_pylist() for c in SUMS)))
        tails = table["tail"].to_pylist()
        anchor = table["anchor"][0].as_py()
        at: dict[int, dict[bytes, list]] = {}
        for conv, (n, children, leaves, saved), tail in zip(ids, sums, tails):
            at.setdefault(len(tail), {})[tail[-1]["key"]] = [conv, n, children, leaves, saved, tail]
        out = []
        for size in range(levels, 0, -1):
            for key, (conv, n, children, leaves, saved, tail) in at.pop(size, {}).items():
                parent = tail[size - 2]["key"] if size > 1 else anchor
                leaves, saved = max(leaves, 1), saved + (n - 1) * tail[size - 1]["words"]
                out.append((conv, top + size, key, parent, n, children, leaves, saved, None, False))
                above = at.setdefault(size - 1, {}).setdefault(parent, [conv, 0, 0, 0, 0, tail])
                above[0] = min(above[0], conv)
                for i, part in enumerate((n, 1, leaves, saved), 1):
                    above[i] += part
        conv, n, children, leaves, saved, _ = at[0][anchor]
        out.append((conv, top, anchor, None, n, children, leaves, saved, table["head"][0].as_py(), True))
        columns = [pa.array(c, f.type) for c, f in zip(zip(*out), arrow_node)]
        return pa.table(columns, schema=arrow_node)

    kinds = {"conv_id": pa.int64(), "depth": pa.int32(), "key": pa.binary(), "parent": pa.binary(), **{c: pa.int64() for c in SUMS}}
    path = pa.list_(pa.struct([("key", pa.binary()), ("words", pa.int32())]))
    arrow_node = pa.schema([*kinds.items(), ("path", path), ("live", pa.bool_())])
    split = rows.select("conv_id", *SUMS, F.slice("path", 1, top).alias("head"), F.slice("path", top + 1, levels).alias("tail"))
    return split.withColumn("anchor", _key(F.col("head"))).groupBy("anchor").applyInArrow(peel, NODE)


def conversation_trie(convs: DataFrame, together: int = 1 << 17) -> DataFrame:
    """Nodes of the trie of ``conv, turns``, the ids being distinct.

    Columns ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``. Where no prefix has more than ``together`` keys below it, a round peels many
    levels, each prefix in a task of its own; elsewhere a round peels one level by a grouping of all rows.
    """
    spark = convs.sparkSession
    zero = F.lit(0).cast("bigint")
    paths = cut_lineage(prefix_keys(convs).withColumn("depth", F.size("path")).sortWithinPartitions("depth"))
    deepest = paths.agg(F.max("depth")).collect()[0][0]
    ending = paths.select(
        "path", F.col("conv").alias("conv_id"), F.lit(1).cast("bigint").alias("n_convs"), *[zero.alias(c) for c in SUMS[1:]], "depth"
    )
    folder = f"{shared_folder(spark).rstrip('/')}/trie-{uuid.uuid4().hex}"
    live, depth, nodes = None, -1 if deepest is None else deepest, None
    while depth >= 0:
        for levels in (64, 8, 1):
            above = depth - levels
            rows = ending.filter((F.col("depth") > above) & (F.col("depth") <= depth)).drop("depth")
            rows = rows if live is None else rows.unionByName(live)
            if levels == 1:
                nodes = _peel_one(rows, depth)
            elif above >= 1:
                rows = cut_lineage(_merged(rows))
                below = rows.groupBy(_key(F.slice("path", 1, above)).alias("anchor")).agg(F.sum(F.size("path")).alias("keys"))
                if below.agg(F.max("keys")).collect()[0][0] > together:
                    continue
                nodes = _peel_many(rows, depth, levels)
            else:
                continue
            break
        nodes.write.parquet(f"{folder}/from={depth}")
        written = spark.read.schema(nodes.schema).parquet(f"{folder}/from={depth}")
        depth -= levels
        if levels == 1:
            live = written.select(F.slice("path", 1, max(depth, 0)).alias("path"), "conv_id", "n_convs", F.lit(1).cast("bigint").alias("n_children"), "n_leaves", "saved")
        else:
            live = written.filter("live").select("path", "conv_id", *SUMS)
    if nodes is None:
        kinds = "bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
        return spark.createDataFrame([], f"conv_id {kinds}")
    nodes = spark.read.schema(nodes.schema).parquet(f"{folder}/from=*").filter("not live").drop("path", "live")
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    ends = sorted_digests(paths.select(_key(F.col("path")).alias("key"), "conv"))
    return (
        nodes.join(parents, "parent", "left")
        .join(ends, "key", "left")
        .select(
            "conv_id",
            F.col("depth").cast("bigint").alias("depth"),
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )


def share_openings(convs: DataFrame, every: int = 20, most: int = 3) -> DataFrame:
    """Each conversation c with its first h turns replaced by those of conversation c - c % ``every``, h being the CRC-32 of c modulo ``most`` + 1."""
    stem = F.col("conv") - F.col("conv") % every
    openings = convs.filter(F.col("conv") % every == 0).select(F.col("conv").alias("stem"), F.slice("turns", 1, most).alias("opening"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % (most + 1)).cast("int")
    cut = convs.withColumn("stem", stem).withColumn("h", h).join(openings, "stem", "left")
    opening = F.slice(F.coalesce("opening", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return cut.select("conv", F.concat(opening, own).alias("turns"))
