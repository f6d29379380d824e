"""Sampled segmentations: lossless, reproducible, and drawn with the right probabilities."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from corvane.llm import blocks, pieces


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load_vocabulary()


def parts(texts):
    return next(blocks.texts(pa.array(texts, pa.string()), 1 << 30))


ODD = ["", " ", "   ", "a", " a", "a  b", "tab\there\n\nnew\r\n", "▁ mark▁s", "½ ﬁ 　é é\x00\x01\x7f", "漢字🙂" * 3, "x" * 3000, "\n", "ÄÖ ß", "the of and in"]


def test_round_trip(vocabulary):
    part = parts(ODD)
    ids, bounds = pieces.sample_block(part, np.arange(len(ODD), dtype=np.uint64), vocabulary)
    data, back = pieces.decode_ids(ids, bounds, vocabulary)
    got = [data[a:b].tobytes().decode() for a, b in zip(back[:-1], back[1:])]
    assert got == ODD


def segmentations(text, table):
    """{ids: probability} of all ways to spell a text."""
    if not text:
        return {(): 1.0}
    out = {}
    for size in range(1, len(text) + 1):
        if text[:size] in table:
            i, log = table[text[:size]]
            for rest, p in segmentations(text[size:], table).items():
                out[(i, *rest)] = p * np.exp(log)
    return out


def test_probabilities(vocabulary):
    table = {vocabulary.pieces[i]: (int(i), log) for i, log in zip(vocabulary.ids, vocabulary.logs)}
    text = "hello"
    want = segmentations(b" " + text.encode(), table)
    total = sum(want.values())
    n = 40000
    ids, bounds = pieces.sample_block(parts([text] * n), blocks.mix(np.arange(n, dtype=np.uint64), 9), vocabulary)
    got = Counter(tuple(ids[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:]))
    assert set(got) <= set(want)
    for key, p in want.items():
        p /= total
        assert abs(got[key] / n - p) < 5 * np.sqrt(p * (1 - p) / n) + 1e-4


def test_columns_and_partitions(spark, make):
    rows = list(enumerate([*ODD, None])) + [(3, ODD[3]), (None, "the end")]
    docs = make(rows)
    one = sorted(map(tuple, pieces.sample_pieces(docs.repartition(1)).collect()), key=str)
    many = sorted(map(tuple, pieces.sample_pieces(docs.repartition(7)).collect()), key=str)
    assert one == many and all(r[3] for r in one)
    back = Counter((r.doc_id, r.text) for r in pieces.decode_pieces(pieces.sample_pieces(docs)).collect())
    assert back == Counter(rows)
    assert pieces.sample_pieces(make([])).count() == 0


def test_model_reads_the_ids(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = pieces.sample_pieces(docs).collect()
    assert len(found) == len(texts)
    for row in found:
        assert row.n_ids == len(row.ids)
        assert model.decode(row.ids) == texts[row.doc_id]


def test_spans_are_hashed_only_where_a_piece_can_go_on(vocabulary, monkeypatch):
    hashed, hasher = [], blocks.span_hasher

    def counted(data, seed=0):
        spans = hasher(data, seed)
        return lambda starts, ends: hashed.append(len(starts)) or spans(starts, ends)

    monkeypatch.setattr(blocks, "span_hasher", counted)
    text = np.frombuffer(b" " + b"qzxjkvw" * 400, np.uint8)
    lattice = pieces.Lattice(text, np.array([0]), np.array([len(text)]), vocabulary)
    known = {p for p in vocabulary.pieces if p}
    raw = text.tobytes()
    want = sorted((i, n) for i in range(len(raw)) for n in range(1, vocabulary.longest + 1) if i + n <= len(raw) and raw[i : i + n] in known)
    plain = lattice.ids >= 0
    assert sorted(zip(lattice.at[plain].tolist(), lattice.size[plain].tolist())) == want
    assert sum(hashed) < 8 * len(text) < vocabulary.longest * len(text)


def test_stable_order():
    rng = np.random.default_rng(1)
    for most in (1, 9, 1 << 16, 1 << 18):
        values = rng.integers(0, most, 5000)
        assert np.array_equal(pieces._stable_order(values), np.argsort(values, kind="stable"))
    assert len(pieces._stable_order(values[:0])) == 0
