"""Token ids of a corpus in files of interleaved range-coded blocks, and back.

``write_tokens`` tokenizes, counts ids over the whole corpus for one shared frequency table, sorts documents by key and lets
every task write one file; ``read_tokens`` lists the files, deals out groups of documents and decodes each from the
checkpoint before it. Ids cross one shuffle, texts none.

Odd rows: a null or empty text has the end id only. Rows without key come last, by the hash of their text; rows with the
same key too. Repeated rows all stay. An empty table gives an empty folder, which reads as no rows. Only the columns named
are read, so further columns may have any name. A task holds a block of whole texts (``blocks.BLOCK_BYTES``, or one longer
text) and its ids; files are written through the file system that the folder names, first under a scratch name, so a lost
executor leaves no half file that a reader would take.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import blocks, range_coder
from corvane.operators.scans import running_total
from corvane.session import cut_lineage

TABLE = "table.arrow"
GROUP = 1 << 20  # ids of the documents that are decoded together


# The word split of the tokenizer, over the letters and signs whose normal form and lower case are theirs alone.
LETTERS = "a-z\u00df-\u00f6\u00f8-\u012f\u0131-\u017e\u0430-\u045f"
PLAIN = re.compile(f"[ -~{LETTERS}\u00c0-\u00d6\u00d8-\u00de\u0400-\u042f\u2010-\u2027]+")
PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]| |[^ 0-9{LETTERS}]+")


def byte_letters() -> dict[int, str]:
    """The letter that stands for a byte in a byte-level vocabulary: itself if it prints, else one from 256 on."""
    printing = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in printing]
    return {b: chr(256 + i) for i, b in enumerate(rest)}


class Lists:
    """Lists of ids one after the other in a growing array, each known by its place."""

    def __init__(self):
        self.ids, self.bounds, self.n = np.zeros(1 << 18, np.uint32), np.zeros(1 << 16, np.int64), 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        begin, end = int(self.bounds[self.n]), int(self.bounds[self.n]) + len(ids)
        if end > len(self.ids):
            self.ids = np.append(self.ids, np.zeros(max(end, len(self.ids)), np.uint32))
        if self.n + len(sizes) >= len(self.bounds):
            self.bounds = np.append(self.bounds, np.zeros(max(len(sizes) + 1, len(self.bounds)), np.int64))
        self.ids[begin:end] = ids
        self.bounds[self.n + 1 : self.n + 1 + len(sizes)] = begin + np.cumsum(sizes)
        self.n += len(sizes)

    def get(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the lists at ``places``, and the number of ids before each list and before the end."""
        begin = self.bounds[places]
        size = self.bounds[places + 1] - begin
        ends = np.cumsum(size)
        return self.ids[np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)], np.concatenate([[0], ends])


class WordIds:
    """Ids of the words of a text, by a tokenizer whose tokens never reach over ASCII white space.

    The ids of words seen are remembered until they and their words pass about ``most`` bytes. With ``split`` (a
    lower-casing byte-level tokenizer that splits by ``PIECES``), words of plain letters and signs are split here and only
    their pieces go through the tokenizer's merges; every other word goes through the whole tokenizer.
    """

    def __init__(self, tokenizer_path: str, most: int = 128 << 20, split: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.split = Tokenizer.from_file(tokenizer_path), most, split
        self.model, self.letters = self.tokenizer.model, {**byte_letters(), 10: "\n"}  # no piece holds a line break
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.pieces: dict[str, int] = {}
        self.of_words, self.of_pieces, self.held = Lists(), Lists(), 0

    def _merged(self, pieces: list[str]) -> list[list[int]]:
        """The ids of each piece. Those that are not ASCII are spelled in the vocabulary's letters, all at once."""
        wide = [i for i, p in enumerate(pieces) if not p.isascii()]
        if wide:
            spelled = "\n".join([pieces[i] for i in wide]).encode().decode("latin-1").translate(self.letters).split("\n")
            for i, p in zip(wide, spelled):
                pieces[i] = p
        merge = self.model.tokenize
        return [[t.id for t in merge(p)] for p in pieces]

    def _flat(self, found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def _whole(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self._flat([e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)])

    def _split(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        pieces = PIECES.findall(text.lower())
        new = set(pieces).difference(self.pieces)
        spelled = [p for p in new if p != " "]
        new = [" "] * (len(new) - len(spelled)) + spelled
        self.of_pieces.add(*self._flat([[]] * (len(new) - len(spelled)) + self._merged([*spelled])))
        self.pieces.update(zip(new, range(len(self.pieces), len(self.pieces) + len(new))))
        places = np.fromiter(map(self.pieces.__getitem__, pieces), np.int64, len(pieces))
        ids, before = self.of_pieces.get(places)
        gaps = np.flatnonzero(places == self.pieces.get(" ", -1))
        self.held += 128 * len(new)
        return ids, np.diff(np.concatenate([[0], before[gaps], before[-1:]]))

    def learn(self, words: list[str]) -> None:
        for a in range(0, len(words), 4096):
            some = words[a : a + 4096]
            lots = [[], some]
            text = " ".join(some)
            if not self.split or not PLAIN.fullmatch(text) or "<|" in text or "" in some:
                whole = [not self.split or "<|" in w or not PLAIN.fullmatch(w) for w in some]
                lots = [[w for w, h in zip(some, whole) if h == want] for want in (True, False)]
            for lot, ids_of in zip(lots, (self._whole, lambda ws: self._split(" ".join(ws)))):
                if lot:
                    ids, sizes = ids_of(lot)
                    self.of_words.add(ids, sizes)
                    self.known.update(zip(lot, range(len(self.known), len(self.known) + len(sizes))))
                    self.held += 4 * len(ids) + 160 * len(sizes) + sum(map(len, lot))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and the number of ids of each text."""
        lists = pc.ascii_split_whitespace(texts)
        found = lists.flatten().dictionary_encode()
        words = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        if self.held > self.most:
            self.forget()
        self.learn([w for w in words if w not in self.known])
        places = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        ids, before = self.of_words.get(places[found.indices.to_numpy()])
        cuts = lists.offsets.to_numpy()
        return ids, np.diff(before[cuts - cuts[0]])


def remembered(tokenizer_path: str) -> WordIds:
    """The ``WordIds`` of this process, which the tasks of a worker share one after the other.

    Functions come to the workers by value, without a module of their own, so it is kept at the tokenizer library's.
    """
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_word_ids", {})
    if tokenizer_path not in kept:
        kept.clear()
        kept[tokenizer_path] = WordIds(tokenizer_path)
    return kept[tokenizer_path]


def tokenize(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", end_id: int | None = 2) -> DataFrame:
    """``key, t`` (hash of the text), ``nth`` (tells equal rows apart), ``n_tokens`` and ``ids`` as little-endian numbers.

    These have 16 bits where the vocabulary allows it, else 32.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, nth = remembered(tokenizer_path), 0
        for batch in batches:
            column = batch.column(2).fill_null("")
            for part in blocks.texts(column, 4 * blocks.BLOCK_BYTES):
                ids, sizes = words.encode(column.slice(part.first, len(part)))
                if end_id is not None:
                    ids = np.insert(ids, np.cumsum(sizes), end_id)
                    sizes = sizes + 1
                width = 4 if words.wide else 2
                raw, ends = ids.astype(f"<u{width}").tobytes(), np.concatenate([[0], np.cumsum(sizes)]) * width
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, len(part)),
                        batch.column(1).slice(part.first, len(part)),
                        pa.array(np.arange(nth, nth + len(part))),
                        pa.array(sizes, pa.int64()),
                        pa.array([raw[a:b] for a, b in zip(ends[:-1], ends[1:])], pa.binary()),
                    ],
                    names=["key", "t", "nth", "n_tokens", "ids"],
                )
                nth += len(part)

    named = docs.select(F.col(key).cast("bigint").alias("key"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("t"), F.col(text).alias("text"))
    return named.mapInArrow(run, "key bigint, t bigint, nth bigint, n_tokens bigint, ids binary")


def _ids_of(column: pa.Array, n: int) -> np.ndarray:
    """All ids of a column of packed ids, ``n`` in number."""
    _, offsets, raw = column.buffers()
    cuts = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    size = int(cuts[-1] - cuts[0])
    return np.frombuffer(raw, f"<u{size // n}", n, cuts[0]) if n else np.zeros(0, np.uint32)


def count_ids(tokens: DataFrame) -> DataFrame:
    """``id, n`` over the whole corpus; one row per id and task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            found = np.bincount(_ids_of(batch.column(1), int(batch.column(0).to_numpy().sum())))
            if len(found) > len(total):
                total = np.append(total, np.zeros(len(found) - len(total), np.int64))
            total[: len(found)] += found
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], names=["id", "n"])

    return tokens.select("n_tokens", "ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int | None = 2,
    file_ids: int = 1 << 22,
) -> DataFrame:
    """Write the corpus into ``folder`` in ascending order of key; returns ``path, n_docs, n_ids, bytes`` per file.

    ``file_ids`` is the mean number of ids of a file. The frequency table goes through the driver: it has one entry per id
    that occurs, which the tokenizer's vocabulary bounds.
    """
    scratch = f"{folder}/_tokens"  # a name that readers pass over
    tokenize(docs, tokenizer_path, key, text, end_id).write.parquet(scratch)
    tokens = docs.sparkSession.read.parquet(scratch)
    counted = count_ids(tokens).toPandas()
    table = range_coder.Table(counted["id"].to_numpy(np.int64), counted["n"].to_numpy(np.int64))
    fs, base = range_coder.open_folder(folder)
    fs.create_dir(base, recursive=True)
    with fs.open_output_stream(f"{base}/{TABLE}") as sink:
        sink.write(range_coder.stream(pa.table({"id": table.ids, "n": table.freq.astype(np.int64)})))
    n_files = max(1, -(-int(counted["n"].sum()) // file_ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        batch = next((b for b in batches if b.num_rows), None)
        if batch is None:
            return
        fs, base = range_coder.open_folder(folder)
        path, scratch = f"{base}/{number:08d}.ids", f"{base}/.{number:08d}-{uuid.uuid4().hex}"
        with fs.open_output_stream(scratch) as sink:
            writer = range_coder.Writer(sink, number, table)
            n_docs = 0
            while batch is not None:
                sizes = batch.column(1).to_numpy()
                writer.add(batch.column(0), sizes, _ids_of(batch.column(2), int(sizes.sum())))
                n_docs += batch.num_rows
                batch = next((b for b in batches if b.num_rows), None)
            writer.close()
        size = fs.get_file_info(scratch).size
        fs.move(scratch, path)
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n_docs]), pa.array([writer.n_ids]), pa.array([size])], names=["path", "n_docs", "n_ids", "bytes"])

    order = [F.col("key").asc_nulls_last(), "t", "nth"]
    ranged = tokens.repartitionByRange(n_files, *order).sortWithinPartitions(*order).select("key", "n_tokens", "ids")
    written = cut_lineage(ranged.mapInArrow(run, "path string, n_docs bigint, n_ids bigint, bytes bigint"))
    fs.delete_dir(f"{base}/_tokens")
    return written


def read_table(folder: str) -> range_coder.Table:
    fs, base = range_coder.open_folder(folder)
    with fs.open_input_file(f"{base}/{TABLE}") as source:
        known = pa.ipc.open_stream(source).read_all()
    table = range_coder.Table(known["id"].to_numpy(), np.ones(len(known)))
    return table.set_slots(known["n"].to_numpy())


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``key, start`` (ids of all documents before), ``n_tokens`` and ``ids`` of each document, from the files alone."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                reader = range_coder.Reader(*range_coder.open_folder(path))
                sizes = reader.docs["n_ids"].to_numpy()
                ends = np.cumsum(sizes)
                firsts = np.unique((ends - sizes) // GROUP, return_index=True)[1]
                lasts = np.append(firsts[1:], len(sizes))
                begins = (ends - sizes)[firsts]
                n_ids = ends[lasts - 1] - begins
                n = len(firsts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * n), pa.array([reader.number] * n), pa.array(firsts), pa.array(lasts), pa.array(begins), pa.array(n_ids)],
                    names=["path", "file", "first", "last", "begin", "n_ids"],
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, reader = None, None
        for batch in batches:
            for row in batch.to_pylist():
                table = table or read_table(folder)
                if reader is None or reader.path != row["path"]:
                    reader = range_coder.Reader(*range_coder.open_folder(row["path"]))
                    reader.path = row["path"]
                docs = reader.docs.slice(row["first"], row["last"] - row["first"])
                sizes = docs["n_ids"].to_numpy()
                raw = reader.ids(table, row["begin"], row["begin"] + row["n_ids"]).astype("<u4").tobytes()
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        docs["key"].combine_chunks(),
                        pa.array(row["start"] + ends - sizes),
                        pa.array(sizes),
                        pa.array([raw[4 * (e - s) : 4 * e] for e, s in zip(ends.tolist(), sizes.tolist())], pa.binary()),
                    ],
                    names=["key", "start", "n_tokens", "ids"],
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(folder).select("path")
    found = cut_lineage(files.mapInArrow(groups, "path string, file bigint, first bigint, last bigint, begin bigint, n_ids bigint"))
    n = found.count()
    placed = running_total(found.withColumn("_all", F.lit(0)).withColumn("_lot", F.expr("file div 1024")), ["_all"], ["_lot"], ["file", "begin"], "n_ids", "start", exclusive=True)
    lots = max(1, min(n, 4 * spark.sparkContext.defaultParallelism + n // 16))
    dealt = placed.select("path", "first", "last", "begin", "n_ids", "start").repartition(lots, "path", "first")
    return dealt.mapInArrow(run, "key bigint, start bigint, n_tokens bigint, ids binary")
