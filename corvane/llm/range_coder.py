"""Static range asymmetric numeral system over integer ids, and the file that holds its blocks.

All files of a corpus share one frequency table. A block holds ``BLOCK`` ids dealt to ``LANES`` interleaved coder states:
id ``i`` of a block goes to lane ``i % LANES`` at step ``i // LANES``. Every ``CHECKPOINT`` steps the states and the place in
the words are kept, so a reader starts at any of them and decodes many such segments side by side.

A file is: header, blocks of 32-bit words, directory, footer. The directory has the blocks (place, ids, checksums of words and
of ids, checkpoints) and the documents (key, ids), each as an Arrow stream. Numbers are little-endian.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs

LANES, CHECKPOINT = 64, 256
SEGMENT = LANES * CHECKPOINT
BLOCK = 4 * SEGMENT
WAITING = 32  # blocks that are coded side by side: a step costs some calls, however wide it is
LOW = np.uint64(1 << 31)  # states stay in [2^31, 2^63) and give or take 32 bits at a time
MAGIC = b"CORVTOK1"
HEADER = "<8sIIIII"  # magic, file number, scale bits, lanes, checkpoint steps, checksum of the table
FOOTER = "<QQQI8s"  # directory begin, its two lengths, its checksum, magic


class Table:
    """Frequencies scaled to a power of two; every id that occurs keeps at least one slot."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray):
        order = np.argsort(ids)
        self.ids, counts = np.asarray(ids, np.int64)[order], np.asarray(counts, np.float64)[order]
        self.scale = max(16, int(len(self.ids)).bit_length() + 2)
        room = 1 << self.scale
        freq = np.maximum(1, np.floor(counts / max(1.0, counts.sum()) * room)).astype(np.int64)
        spare = room - int(freq.sum())
        if len(freq):
            if spare > 0:
                freq[np.argmax(freq)] += spare
            while spare < 0:  # the most frequent ids give back what the rarest got, each at most half of its own
                give = np.minimum(freq // 2, -spare)
                i = int(np.argmax(give))
                freq[i] -= give[i]
                spare += int(give[i])
        self.place = np.zeros(int(self.ids[-1]) + 1 if len(self.ids) else 1, np.uint32)
        self.place[self.ids] = np.arange(len(self.ids))
        self.set_slots(freq)

    def set_slots(self, freq: np.ndarray) -> Table:
        """Take these slots, one number for each id, as they are."""
        self.freq = freq.astype(np.uint64)
        self.start = (np.cumsum(freq) - freq).astype(np.uint64)
        self.limit = self.freq << np.uint64(63 - self.scale)
        self.crc = zlib.crc32(self.ids.astype("<i8").tobytes() + freq.astype("<i8").tobytes())
        self._slots: np.ndarray | None = None
        return self

    @property
    def slots(self) -> np.ndarray:
        """The symbol of each slot, for decoding."""
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.ids), dtype=np.uint32), self.freq.astype(np.int64))
        return self._slots


def encode(table: Table, ids: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
    """Blocks of ``ids``: words, number of ids, states of each checkpoint, words before each checkpoint."""
    full = len(ids) // BLOCK
    for part, rows in ((ids[: full * BLOCK], full), (ids[full * BLOCK :], 1)):
        if len(part):
            yield from _encode(table, part, rows)


def _encode(table: Table, ids: np.ndarray, rows: int) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
    size = len(ids) // rows
    steps = -(-size // LANES)
    filled = np.full(rows * steps * LANES, np.argmax(table.freq), np.uint32)  # lanes left over code the cheapest id
    filled[: len(ids)] = table.place[ids]
    symbols = filled.reshape(rows, steps, LANES)
    state = np.full((rows, LANES), LOW)
    words = np.empty((rows, steps, LANES), np.uint32)
    given = np.empty((rows, steps, LANES), bool)
    kept = np.empty((rows, -(-steps // CHECKPOINT), LANES), np.uint64)
    scale, half = np.uint64(table.scale), np.uint64(32)
    for t in range(steps - 1, -1, -1):
        s = symbols[:, t]
        f = table.freq[s]
        over = state >= table.limit[s]
        words[:, t], given[:, t] = state.astype(np.uint32), over
        state = np.where(over, state >> half, state)
        whole = state // f
        state = (whole << scale) + (state - whole * f) + table.start[s]
        if t % CHECKPOINT == 0:
            kept[:, t // CHECKPOINT] = state
    before = np.cumsum(given.sum(axis=2), axis=1)
    for r in range(rows):
        at = [0] + [int(before[r, t - 1]) for t in range(CHECKPOINT, steps, CHECKPOINT)]
        yield words[r][given[r]], size, kept[r], np.array(at, np.uint32)


def decode(table: Table, words: np.ndarray, places: np.ndarray, states: np.ndarray, steps: int) -> np.ndarray:
    """The ids of segments of equal length, one row each; ``places`` says where a segment's words begin."""
    width = len(places)
    x = states.reshape(width, LANES).copy()
    at = places.astype(np.int64).copy()
    out = np.empty((steps, width, LANES), np.uint32)
    scale, half, mask = np.uint64(table.scale), np.uint64(32), np.uint64((1 << table.scale) - 1)
    words = np.append(words, np.uint32(0)).astype(np.uint64)
    for t in range(steps):
        slot = x & mask
        s = table.slots[slot]
        out[t] = s
        x = table.freq[s] * (x >> scale) + slot - table.start[s]
        low = x < LOW
        nth = np.cumsum(low, axis=1)
        w = words[np.minimum(at[:, None] + nth - 1, len(words) - 1)]
        x = np.where(low, (x << half) | w, x)
        at += nth[:, -1]
    return table.ids[out.transpose(1, 0, 2).reshape(width, steps * LANES)]


def open_folder(folder: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a URI such as ``file:/x``, ``hdfs://…`` or ``s3://…``, and the path in it."""
    if folder.startswith("file:"):
        return pa.fs.LocalFileSystem(), "/" + folder[len("file:") :].lstrip("/")
    if "://" not in folder:
        return pa.fs.LocalFileSystem(), folder
    return pa.fs.FileSystem.from_uri(folder)


def stream(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


class Writer:
    """One file; ids and documents are added in order, and at most ``WAITING`` blocks wait in memory to be coded together."""

    def __init__(self, sink, number: int, table: Table):
        self.sink, self.table = sink, table
        self.place = sink.write(struct.pack(HEADER, MAGIC, number, table.scale, LANES, CHECKPOINT, table.crc))
        self.waiting: list[np.ndarray] = []
        self.n_waiting, self.n_ids = 0, 0
        self.blocks: dict[str, list] = {c: [] for c in ("place", "n_words", "n_ids", "words_crc", "ids_crc", "states", "ats")}
        self.docs: list[pa.Table] = []

    def add(self, keys: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Documents by key and number of ids, and all their ids."""
        self.docs.append(pa.table({"key": keys, "n_ids": pa.array(sizes, pa.int64())}))
        self.n_ids += len(ids)
        for a in range(0, len(ids), WAITING * BLOCK):
            self.waiting.append(ids[a : a + WAITING * BLOCK])
            self.n_waiting += len(self.waiting[-1])
            if self.n_waiting >= WAITING * BLOCK:
                self._put(self.n_waiting // BLOCK * BLOCK)

    def _put(self, n: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        self.waiting, self.n_waiting = [ids[n:]], len(ids) - n
        first = 0
        for words, size, states, ats in encode(self.table, ids[:n]):
            raw = words.astype("<u4").tobytes()
            known = ids[first : first + size].astype("<u4").tobytes()
            first += size
            for name, value in zip(self.blocks, (self.place, len(words), size, zlib.crc32(raw), zlib.crc32(known), states.astype("<u8").tobytes(), ats.astype("<u4").tobytes())):
                self.blocks[name].append(value)
            self.place += self.sink.write(raw)

    def close(self) -> None:
        self._put(self.n_waiting)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        blocks = stream(pa.table({k: pa.array(v, t) for (k, v), t in zip(self.blocks.items(), kinds)}))
        docs = stream(pa.concat_tables(self.docs))
        self.sink.write(blocks + docs + struct.pack(FOOTER, self.place, len(blocks), len(docs), zlib.crc32(docs, zlib.crc32(blocks)), MAGIC))


class Reader:
    """The directory of a file, and the ids of any range of it; damage raises ``ValueError``."""

    def __init__(self, fs: pa.fs.FileSystem, path: str):
        self.file, self.path = fs.open_input_file(path), path
        size = self.file.size()
        if size < struct.calcsize(HEADER) + struct.calcsize(FOOTER):
            raise ValueError(f"{path} is cut short")
        magic, self.number, self.scale, lanes, steps, self.table_crc = struct.unpack(HEADER, self.file.read_at(struct.calcsize(HEADER), 0))
        begin, n_blocks, n_docs, crc, end = struct.unpack(FOOTER, self.file.read_at(struct.calcsize(FOOTER), size - struct.calcsize(FOOTER)))
        if (magic, end) != (MAGIC, MAGIC) or (lanes, steps) != (LANES, CHECKPOINT):
            raise ValueError(f"{path} is no token file of this kind")
        raw = self.file.read_at(n_blocks + n_docs, begin)
        if zlib.crc32(raw) != crc:
            raise ValueError(f"{path}: damaged directory")
        self.blocks, self.docs = (pa.ipc.open_stream(raw[a:b]).read_all() for a, b in ((0, n_blocks), (n_blocks, n_blocks + n_docs)))
        self.sizes = self.blocks["n_ids"].to_numpy()
        self.bounds = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)

    def ids(self, table: Table, first: int, last: int) -> np.ndarray:
        """Ids ``first`` to ``last`` of the file: whole blocks are checked, the rest is decoded from the checkpoint before."""
        if table.crc != self.table_crc:
            raise ValueError(f"{self.path} was written with another frequency table")
        if last <= first:
            return np.zeros(0, np.uint32)
        a = int(np.searchsorted(self.bounds, first, "right")) - 1
        b = int(np.searchsorted(self.bounds, last, "left"))
        part = self.blocks.slice(a, b - a).to_pydict()
        begin = part["place"][0]
        raw = self.file.read_at(part["place"][-1] + 4 * part["n_words"][-1] - begin, begin)
        words = np.frombuffer(raw, "<u4")
        lots: dict[int, list] = {}  # by number of steps: place of the words, states, place of the ids
        for i in range(b - a):
            n, word, id0 = part["n_ids"][i], (part["place"][i] - begin) // 4, int(self.bounds[a + i])
            if zlib.crc32(raw[4 * word : 4 * (word + part["n_words"][i])]) != part["words_crc"][i]:
                raise ValueError(f"{self.path}: damaged block {a + i}")
            states = np.frombuffer(part["states"][i], "<u8").reshape(-1, LANES)
            for c, at in enumerate(np.frombuffer(part["ats"][i], "<u4")):
                size = min(SEGMENT, n - c * SEGMENT)
                begins = id0 + c * SEGMENT
                if begins < last and begins + size > first:
                    lots.setdefault(-(-size // LANES), []).append((word + int(at), states[c], begins, size))
        begins = min(lot[2] for lots_ in lots.values() for lot in lots_)
        ends = max(lot[2] + lot[3] for lots_ in lots.values() for lot in lots_)
        out = np.empty(ends - begins, np.uint32)
        for steps, segments in lots.items():
            for j in range(0, len(segments), 128):
                some = segments[j : j + 128]
                got = decode(table, words, np.array([s[0] for s in some]), np.stack([s[1] for s in some]), steps)
                for row, (_, _, at, size) in zip(got, some):
                    out[at - begins : at - begins + size] = row[:size]
        for i in range(b - a):
            p, q = self.bounds[a + i], self.bounds[a + i + 1]
            if p >= begins and q <= ends and zlib.crc32(out[p - begins : q - begins].astype("<u4").tobytes()) != part["ids_crc"][i]:
                raise ValueError(f"{self.path}: block {a + i} decodes to other ids")
        return out[first - begins : last - begins]
