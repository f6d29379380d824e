"""Range-coded token files against the tokenizer itself, exact round trips, damage and odd rows."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from corvane.llm import queries, range_coder, token_files

TOKENIZER = queries.tokenizer_path("word_bpe_49k.json")
FOLDER = "/root/testdata/sf0.001"


def plain(rows):
    """``key, start, n_tokens, ids`` by encoding each text whole."""
    from tokenizers import Tokenizer

    tokenizer, at, out = Tokenizer.from_file(TOKENIZER), 0, []
    for key, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((key, at, len(ids), np.array(ids, "<u4").tobytes()))
        at += len(ids)
    return out


def there_and_back(spark, df, folder, **more):
    token_files.write_tokens(df, str(folder), TOKENIZER, **more)
    return [(r.key, r.start, r.n_tokens, bytes(r.ids)) for r in token_files.read_tokens(spark, str(folder)).orderBy("start").collect()]


def test_query_against_the_tokenizer(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = queries.op11_range_coded_tokens(spark, FOLDER).orderBy("doc_id").collect()
    want = [(k, s, n, zlib.crc32(i)) for k, s, n, i in plain([tuple(r) for r in docs])]
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == want


ODD = [
    (5, "Plain words, twice. Plain words, twice."),
    (-3, ""),
    (0, " \t\n\r\x0b\x0c "),
    (9, "a\x1cb \x85 c d e ́x é Å İ ΣΑΣ ǅ"),
    (2, "##2# # ## don't I'LL 12 345 ½ ٣ <|endoftext|>x<|startoftext|> y"),
    (3, "漢字かな交じり文 한국어 текст العربية 🙂👩‍👩‍👧"),
    (10**15, "x" * 5000 + " " + "y1" * 4000),
]


def test_odd_texts(spark, make, tmp_path):
    got = there_and_back(spark, make(ODD), tmp_path / "a", file_ids=1000)
    assert got == plain(sorted(ODD))


def test_nulls_repeats_and_ties(spark, make, tmp_path):
    rows = [(None, "no key"), (1, None), (1, "same"), (1, "same"), (1, "other"), (None, None), (2, "same"), (None, "no key")]
    got = there_and_back(spark, make(rows), tmp_path / "a", file_ids=2)
    assert [g[0] for g in got] == [1, 1, 1, 1, 2, None, None, None]
    tokens = lambda found: sorted((str(g[0]), g[3]) for g in found)
    assert tokens(got) == tokens(plain(rows))
    assert [g[1] for g in got] == np.cumsum([0] + [g[2] for g in got])[:-1].tolist()


def test_empty_table(spark, make, tmp_path):
    assert there_and_back(spark, make([]), tmp_path / "a") == []


def test_a_long_text_over_many_blocks_between_short_ones(spark, make, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(map(str, rng.integers(0, 10**6, n)))) for i, n in enumerate((3, 60_000, 1, 0, 2000, 5))]
    assert there_and_back(spark, make(rows), tmp_path / "a") == plain(rows)


def test_words_are_forgotten_and_learned_again():
    words = token_files.WordIds(TOKENIZER, most=2000)
    text = " ".join(f"word{i} Étion{i % 7}." for i in range(500))
    texts = pa.array([text[:100], "", text[100:]])
    want = words.encode(texts)
    for _ in range(3):
        got = words.encode(texts)
        assert (got[0] == want[0]).all() and got[1].tolist() == want[1].tolist()


def test_words_against_the_whole_tokenizer():
    from tokenizers import Tokenizer

    tokenizer, words = Tokenizer.from_file(TOKENIZER), token_files.WordIds(TOKENIZER, most=200_000)
    rng = np.random.default_rng(8)
    known = "abcsStTrReEvVmMlLdD'’\"<|>0189 \n.,;:!?()#$-–—…“”‧ßÀÖØÞàöøÿĀİıſŁžŸАЯяёЁЏџ"
    any_ = [chr(c) for c in (*range(0, 0x250), *range(0x300, 0x310), *range(0x370, 0x500), *range(0x2000, 0x2070), 0x4E00, 0xAC00, 0x1100, 0x1161, 0x1F642, 0x3000, 0xFB01)]
    for letters, most in ((list(known), 40), (any_, 30), (list(known) + any_, 60)):
        texts = ["".join(rng.choice(letters, rng.integers(0, most))) for _ in range(4000)]
        ids, sizes = words.encode(pa.array(texts))
        for text, got in zip(texts, np.split(ids, np.cumsum(sizes)[:-1])):
            assert got.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def table_of(ids):
    return range_coder.Table(*np.unique(ids, return_counts=True))


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, range_coder.SEGMENT + 1, range_coder.BLOCK, 9 * range_coder.BLOCK + 5])
def test_any_range_of_a_file(tmp_path, n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.2, size=n + 1) % 50_000).astype(np.uint32)[:n]
    table = table_of(np.append(ids, 7))
    with open(tmp_path / "f", "wb") as sink:
        writer = range_coder.Writer(sink, 1, table)
        writer.add(pa.array([4], pa.int64()), np.array([n]), ids)
        writer.close()
    reader = range_coder.Reader(*range_coder.open_folder(f"file://{tmp_path}/f"))
    assert (reader.ids(table, 0, n) == ids).all()
    for a, b in (sorted(rng.integers(0, n + 1, 2)) for _ in range(8)):
        assert (reader.ids(table, a, b) == ids[a:b]).all()


def test_size_is_near_the_entropy(tmp_path):
    ids = (np.random.default_rng(1).zipf(1.3, size=600_000) % 49_408).astype(np.uint32)
    table = table_of(ids)
    size = sum(words.nbytes + states.nbytes for words, _, states, _ in range_coder.encode(table, ids))
    p = np.unique(ids, return_counts=True)[1] / len(ids)
    assert size < 1.06 * -(p * np.log2(p)).sum() * len(ids) / 8


def test_table_keeps_rare_ids():
    table = range_coder.Table(np.arange(60_000), np.append(np.ones(59_999), 1e12))
    assert table.freq.min() >= 1 and int(table.freq.sum()) == 1 << table.scale


@pytest.mark.parametrize("where", ["block", "directory", "end"])
def test_damage_is_found(tmp_path, where):
    ids = np.arange(100_000, dtype=np.uint32) % 321
    table = table_of(ids)
    with open(tmp_path / "f", "wb") as sink:
        writer = range_coder.Writer(sink, 1, table)
        writer.add(pa.array([4], pa.int64()), np.array([len(ids)]), ids)
        writer.close()
    raw = bytearray((tmp_path / "f").read_bytes())
    if where == "end":
        raw = raw[: len(raw) // 2]
    else:
        raw[{"block": 5000, "directory": -200}[where]] ^= 1
    (tmp_path / "f").write_bytes(raw)
    with pytest.raises(ValueError):
        range_coder.Reader(*range_coder.open_folder(str(tmp_path / "f"))).ids(table, 0, len(ids))


def test_another_table_is_refused(tmp_path):
    ids = np.arange(1000, dtype=np.uint32)
    with open(tmp_path / "f", "wb") as sink:
        writer = range_coder.Writer(sink, 1, table_of(ids))
        writer.add(pa.array([4], pa.int64()), np.array([1000]), ids)
        writer.close()
    with pytest.raises(ValueError):
        range_coder.Reader(*range_coder.open_folder(str(tmp_path / "f"))).ids(table_of(ids[:500]), 0, 10)


def test_blocks_are_coded_side_by_side(monkeypatch):
    import io

    widths, plain_encode = [], range_coder._encode
    monkeypatch.setattr(range_coder, "_encode", lambda table, ids, rows: widths.append(rows) or plain_encode(table, ids, rows))
    ids = np.random.default_rng(2).integers(0, 50, 32 * range_coder.BLOCK + 7).astype(np.uint16)
    table = range_coder.Table(*np.unique(ids, return_counts=True))
    sink = io.BytesIO()
    writer = range_coder.Writer(sink, 0, table)
    for part in np.array_split(ids, 100):
        writer.add(pa.array([1]), np.array([len(part)]), part)
    writer.close()
    assert widths == [32, 1] and writer.n_ids == len(ids)


def test_pieces_of_all_letters_are_merged_together():
    words = token_files.WordIds(TOKENIZER)
    pieces = ["plain", "é", "straße", "x1", "\u0151z", "д", ","]
    assert words._merged([*pieces]) == [words._merged([p])[0] for p in pieces]
    assert words._merged([]) == []
