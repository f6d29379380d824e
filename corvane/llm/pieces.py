"""Sampled SentencePiece segmentations by forward filtering and backward sampling over the piece lattice, and decoding.

The vocabulary comes from a SentencePiece model; its path is a parameter, and the driver sends the table to the workers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm import blocks

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
FILTER_BITS = 22
SPACE = 32


@dataclass
class Vocabulary:
    """Pieces as bytes, with a plain space for the model's space mark."""

    pieces: list[bytes]  # by id; empty for pieces that stand for no text
    hashes: np.ndarray  # of the pieces that may be sampled, ascending
    ids: np.ndarray  # their ids, in the same order
    logs: np.ndarray  # their log probabilities
    byte_ids: np.ndarray  # ids of the 256 byte pieces
    byte_log: float
    longest: int

    def __post_init__(self):
        self.maybe = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.maybe[_slots(self.hashes)] = True
        # where a longer piece may begin like this
        self.begins = np.zeros(1 << FILTER_BITS, dtype=bool)
        plain = [self.pieces[i] for i in self.ids.tolist()]
        ends = np.cumsum([len(p) for p in plain])
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        hashes = blocks.span_hasher(np.frombuffer(b"".join(plain), dtype=np.uint8))
        for size in range(1, self.longest):
            longer = starts[ends - starts > size]
            self.begins[_slots(hashes(longer, longer + size))] = True


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _stable_order(values: np.ndarray) -> np.ndarray:
    """What a stable ``argsort`` of numbers from 0 below 2^32 gives, by two sorts of 16 bits, which numpy does by radix."""
    order = np.argsort(values.astype(np.uint16), kind="stable")
    if values.max(initial=0) >> 16:
        order = order[np.argsort((values >> 16).astype(np.uint16)[order], kind="stable")]
    return order


def load_vocabulary(path: str = MODEL, temperature: float = 1.0) -> Vocabulary:
    """Read a model with byte fallback. Unigram scores are log probabilities; merge ranks of a byte-pair model, which
    are whole numbers, become probabilities proportional to ``1 / (1 + rank)``. ``temperature`` divides the logs."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    scores = np.array([model.get_score(i) for i in plain], dtype=np.float64)
    if (scores == np.round(scores)).all():
        scores = -np.log1p(-scores)
        scores -= np.log(np.exp(scores).sum())
    pieces = [b""] * n
    byte_ids = np.full(256, -1, dtype=np.int32)
    for i in range(n):
        if model.is_byte(i):
            byte = int(model.id_to_piece(i)[3:5], 16)
            byte_ids[byte], pieces[i] = i, bytes([byte])
    for i in plain:
        pieces[i] = model.id_to_piece(i).replace("▁", " ").encode()
    if (byte_ids < 0).any():
        raise ValueError("the model has no byte fallback")
    if any(b" " in pieces[i].lstrip(b" ") for i in plain):
        raise ValueError("a piece holds a space after another character")
    raw = np.frombuffer(b"".join(pieces[i] for i in plain), dtype=np.uint8)
    ends = np.cumsum([len(pieces[i]) for i in plain])
    starts = np.concatenate([[0], ends[:-1]])
    hashes = blocks.span_hashes(raw, starts, ends)
    order = np.argsort(hashes)
    logs = scores / temperature
    return Vocabulary(pieces, hashes[order], np.array(plain, np.int32)[order], logs[order], byte_ids, float(logs.min()), int((ends - starts).max()))


def _chunks(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the parts of texts begin that no piece crosses: texts, runs of spaces, and control characters."""
    n = len(data)
    cut = np.zeros(n + 1, dtype=bool)
    cut[bounds] = True
    space, control = data == SPACE, data < SPACE
    cut[1:n] |= (space[1:] & ~space[:-1]) | control[1:] | control[:-1]
    starts = np.flatnonzero(cut[:n])
    return starts, np.concatenate([starts[1:], [n]]) if len(starts) else starts


class Lattice:
    """All segmentations of some distinct chunks: edges by the node they end at, with the chance to be drawn there."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, vocabulary: Vocabulary):
        sizes = ends - starts
        self.first = np.concatenate([[0], np.cumsum(sizes + 1)])  # node of each chunk's begin
        total = int(sizes.sum())
        cuts = np.concatenate([[0], np.cumsum(sizes)])
        chunk = np.repeat(np.arange(len(starts)), sizes)
        inside = np.arange(total) - cuts[chunk]
        body = data[starts[chunk] + inside]
        left = sizes[chunk] - inside
        node = self.first[chunk] + inside
        origin, length, piece, weight = [], [], [], []
        spans, open_ = blocks.span_hasher(body), np.arange(total)
        for size in range(1, min(vocabulary.longest, int(sizes.max(initial=0))) + 1):
            open_ = open_[left[open_] >= size]
            hashes = spans(open_, open_ + size)
            slots = _slots(hashes)
            likely = vocabulary.maybe[slots]
            at, hashes = open_[likely], hashes[likely]
            open_ = open_[vocabulary.begins[slots]]  # elsewhere no piece goes on beyond this size
            row = np.minimum(np.searchsorted(vocabulary.hashes, hashes), len(vocabulary.hashes) - 1)
            hit = vocabulary.hashes[row] == hashes
            origin.append(at[hit])
            length.append(np.full(int(hit.sum()), size))
            piece.append(vocabulary.ids[row[hit]])
            weight.append(vocabulary.logs[row[hit]])
        # a character without a piece of its own is spelled in bytes
        head = np.flatnonzero((body & 0xC0) != 0x80)
        width = np.diff(np.concatenate([head, [total]]))
        own = np.zeros(total * 5 if total else 0, dtype=bool)
        for at, size in zip(origin, length):
            if len(size) and size[0] < 5:
                own[at * 5 + size[0]] = True
        bare = ~own[head * 5 + width] if total else np.zeros(0, bool)
        origin.append(head[bare])
        length.append(width[bare])
        piece.append(np.full(int(bare.sum()), -1, np.int32))
        weight.append(width[bare] * vocabulary.byte_log)
        at, size = np.concatenate(origin), np.concatenate(length).astype(np.int64)
        ids, logs = np.concatenate(piece), np.concatenate(weight)
        # forward: edges in order of their begin within the chunk; those of one begin reach different nodes
        order = _stable_order(inside[at])
        at, size, ids, logs = at[order], size[order], ids[order], logs[order]
        begin, end = node[at], node[at] + size
        alpha = np.full(int(self.first[-1]), -np.inf)
        alpha[self.first[:-1]] = 0.0
        turns = np.searchsorted(inside[at], np.arange(int(sizes.max(initial=0)) + 1))
        for a, b in zip(turns[:-1], turns[1:]):
            to = end[a:b]
            alpha[to] = np.logaddexp(alpha[to], alpha[begin[a:b]] + logs[a:b])
        # backward: the chance of each edge among those that end at its node, summed up within the node
        order = _stable_order(end)
        self.begin, end, self.ids, self.at, self.size = begin[order], end[order], ids[order], at[order], size[order]
        with np.errstate(invalid="ignore"):
            chance = np.exp(alpha[self.begin] + logs[order] - alpha[end])
        chance = np.nan_to_num(chance)
        self.edges = np.searchsorted(end, np.arange(int(self.first[-1]) + 1))
        summed = np.cumsum(chance)
        before = np.concatenate([[0.0], summed])[self.edges[end]]
        self.upto = summed - before
        self.body = body
        self.last = self.first[1:] - 1

    def sample(self, chunk: np.ndarray, place: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Edges drawn for occurrences of chunks, in text order, and how many for each occurrence.

        The draw at a node is fixed by the seed of the row and the place of the node in its text.
        """
        node, home = self.last[chunk], self.first[chunk]
        active = np.arange(len(chunk))
        drawn: list[tuple[np.ndarray, np.ndarray]] = []
        counts = np.zeros(len(chunk), np.int64)
        while len(active):
            at = node[active]
            spot = (place[active] + at - home[active]).astype(np.uint64)
            u = blocks.unit(blocks.mix(seed[active] ^ blocks.mix(spot, 5), 6))
            edge, last = self.edges[at], self.edges[at + 1] - 1
            u *= self.upto[last]
            open_ = np.flatnonzero((self.upto[edge] <= u) & (edge < last))
            while len(open_):
                edge[open_] += 1
                open_ = open_[(self.upto[edge[open_]] <= u[open_]) & (edge[open_] < last[open_])]
            drawn.append((active, edge))
            counts[active] += 1
            node[active] = self.begin[edge]
            active = active[node[active] > home[active]]
        cuts = np.cumsum(counts)
        out = np.zeros(int(cuts[-1]) if len(cuts) else 0, np.int64)
        for turn, (who, edge) in enumerate(drawn):
            out[cuts[who] - 1 - turn] = edge
        return out, counts


def _expand(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs ``flat[start : start + count]`` one after the other."""
    total = np.cumsum(counts)
    if not len(total):
        return flat[:0]
    return flat[np.repeat(starts - (total - counts), counts) + np.arange(total[-1])]


def sample_block(part: blocks.Texts, seeds: np.ndarray, vocabulary: Vocabulary, lattice_bytes: int = 1 << 17) -> tuple[np.ndarray, np.ndarray]:
    """Ids of sampled segmentations of the texts of a block, and where each text's begin.

    Lattices are built for about ``lattice_bytes`` of distinct chunks at a time, and one chunk at least.
    """
    sizes = np.diff(part.bounds)
    extra = (sizes > 0).astype(np.int64)  # a space stands before every text that is not empty
    bounds = np.concatenate([[0], np.cumsum(sizes + extra)]).astype(np.int64)
    data = np.full(int(bounds[-1]), SPACE, dtype=np.uint8)
    owner = np.repeat(np.arange(len(part)), sizes)
    data[np.arange(len(part.data)) + np.cumsum(extra)[owner]] = part.data
    starts, ends = _chunks(data, bounds)
    row = np.searchsorted(bounds, starts, side="right") - 1
    _, chosen, chunk = np.unique(blocks.span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    lot = np.cumsum(ends[chosen] - starts[chosen]) // lattice_bytes
    by_lot = np.argsort(lot[chunk], kind="stable") if len(chunk) else np.zeros(0, np.int64)
    lots, firsts = np.unique(lot, return_index=True)
    turns = np.searchsorted(lot[chunk][by_lot], np.append(lots, len(lot) + data.size + 1))
    found = []
    chunk_tokens = np.zeros(len(chunk), np.int64)
    for a, b, first, last in zip(turns[:-1], turns[1:], firsts, np.append(firsts[1:], len(lot))):
        mine = by_lot[a:b]
        ids, counts = _sampled(data, starts, ends, chosen[first:last], chunk[mine] - first, starts[mine] - bounds[row[mine]], seeds[row[mine]], vocabulary)
        chunk_tokens[mine] = counts
        found.append(ids)
    # the lots' ids stand by lot, those of the block by place
    flat = np.concatenate(found) if found else np.zeros(0, np.int32)
    begin = np.zeros(len(chunk), np.int64)
    begin[by_lot] = np.cumsum(chunk_tokens[by_lot]) - chunk_tokens[by_lot]
    text_tokens = np.bincount(row, weights=chunk_tokens, minlength=len(part)).astype(np.int64)
    return _expand(flat, begin, chunk_tokens), np.concatenate([[0], np.cumsum(text_tokens)])


def _sampled(data, starts, ends, chosen, chunk, place, seeds, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids drawn for occurrences of some distinct chunks, one occurrence after the other, and their numbers."""
    lattice = Lattice(data, starts[chosen], ends[chosen], vocabulary)
    edges, counts = lattice.sample(chunk, place, seeds)
    spelled = lattice.ids[edges] < 0
    tokens = np.where(spelled, lattice.size[edges], 1)
    flat = np.concatenate([lattice.ids, vocabulary.byte_ids[lattice.body]])
    ids = _expand(flat, np.where(spelled, len(lattice.ids) + lattice.at[edges], edges), tokens)
    return ids, np.add.reduceat(tokens, np.cumsum(counts) - counts) if len(tokens) else np.zeros(0, np.int64)


def decode_ids(ids: np.ndarray, bounds: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of lists of ids, and where each list's begin; the first space of each goes."""
    flat = np.frombuffer(b"".join(vocabulary.pieces), dtype=np.uint8)
    sizes = np.array([len(p) for p in vocabulary.pieces])
    starts = np.cumsum(sizes) - sizes
    data = _expand(flat, starts[ids], sizes[ids])
    ends = np.concatenate([[0], np.cumsum(sizes[ids])])[bounds]
    full = np.flatnonzero(np.diff(ends))
    first = full[data[ends[full]] == SPACE]
    keep = np.ones(len(data), dtype=bool)
    keep[ends[first]] = False
    short = np.zeros(len(bounds), np.int64)
    short[first + 1] = 1
    return data[keep], ends - np.cumsum(short)


def sample_pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: Vocabulary | None = None, seed: int = 6) -> DataFrame:
    """One row per document: ``key, ids, n_ids, lossless``.

    A segmentation is drawn with its probability among all segmentations of the text into pieces: the product of the
    pieces' probabilities. The forward pass sums over the lattice once per distinct chunk of a block (no piece crosses
    the begin of a run of spaces or a control character), the backward pass draws the pieces of every occurrence from
    its end. The draws are fixed by ``seed``, the row's key and the place in the text, whatever the partitions are;
    rows with equal keys and texts get equal ids. Characters without a piece are spelled in byte pieces, so decoding
    gives the text back; ``lossless`` says that it did.

    Null text gives null ids; empty text no ids. A null key seeds as one value of its own.
    """
    vocabulary = vocabulary or load_vocabulary()
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(seed)).alias("seed"))
    kind = dict(source.dtypes)["key"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seeds = batch.column(2).to_numpy().view(np.uint64)
            for part in blocks.texts(batch.column(1)):
                ids, bounds = sample_block(part, seeds[part.first : part.last], vocabulary)
                data, back = decode_ids(ids, bounds, vocabulary)
                same = np.array_equal(back, part.bounds) and np.array_equal(data, part.data)
                if same:
                    lossless = np.ones(len(part), dtype=bool)
                else:
                    lossless = np.array([np.array_equal(data[back[i] : back[i + 1]], part.data[part.bounds[i] : part.bounds[i + 1]]) for i in range(len(part))])
                none = batch.column(1).slice(part.first, len(part)).is_null().to_numpy(zero_copy_only=False)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32), mask=np.append(none, False)), pa.array(ids, pa.int32()))
                counts = pa.array(np.diff(bounds))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.first, len(part)), lists, counts, pa.array(lossless)], names=["key", "ids", "n_ids", "lossless"])

    out = source.mapInArrow(encode, f"key {kind}, ids array<int>, n_ids bigint, lossless boolean")
    return out.withColumnRenamed("key", key)


def decode_pieces(encoded: DataFrame, key: str = "doc_id", vocabulary: Vocabulary | None = None) -> DataFrame:
    """``(key, text)`` of rows with ``key, ids``; null ids give null text."""
    vocabulary = vocabulary or load_vocabulary()
    source = encoded.select(F.col(key).alias("key"), "ids")
    kind = dict(source.dtypes)["key"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            bounds = lists.offsets.to_numpy().astype(np.int64)
            data, cuts = decode_ids(lists.values.to_numpy()[bounds[0] : bounds[-1]], bounds - bounds[0], vocabulary)
            raw = data.tobytes()
            texts = [raw[a:b].decode() if ok else None for a, b, ok in zip(cuts[:-1], cuts[1:], lists.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["key", "text"])

    return source.mapInArrow(decode, f"key {kind}, text string").withColumnRenamed("key", key)
