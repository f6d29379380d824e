"""Counts after edits against encoding the edited text anew."""

import random

import pyarrow as pa
import pytest

from corvane.llm import token_counts as tc

BITS = ["the", " of", "'re", "'", "r", "e", "ll", " ", "  ", "\n", "\n\n ", "\t", "12", "3", "é", "漢字", "🙂", "!!", " - ", "'s", "word", "\u00a0", "x" * 30, ""]


@pytest.fixture(scope="module")
def counter():
    return tc.Counter(open(tc.RANKS, "rb").read())


@pytest.fixture(scope="module")
def whole():
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(tc.RANKS, "rb").read().splitlines()) if a}
    return tiktoken.Encoding("whole", pat_str=tc.PATTERN, mergeable_ranks=ranks, special_tokens={})


def plant(text, counter):
    pieces = counter.pattern.findall(text)
    return tc.SegmentTree.over([len(p) for p in pieces], counter.counts(pieces))


def test_edits(counter, whole):
    draw = random.Random(9)
    for turn in range(400):
        text = "".join(draw.choices(BITS, k=draw.choice([0, 1, 3, 20, 400])))
        tree = plant(text, counter)
        for _ in range(draw.randint(1, 6)):
            at, cut = draw.randint(-1, len(text) + 2), draw.choice([0, 0, 1, 2, 5, 60, 10**6])
            put = "".join(draw.choices(BITS, k=draw.choice([0, 1, 2, 8, 200])))
            lo = min(max(at, 0), len(text))
            want = text[:lo] + put + text[lo + cut :]
            text, n = tc.edit(text, tree, at, cut, put, counter)
            assert text == want
            pieces = counter.pattern.findall(text)
            assert [x for b in tree.leaf_chars for x in b] == [len(p) for p in pieces]
            assert tree.tokens[1] == len(whole.encode_ordinary(text)) and tree.chars[1] == len(text)
            assert all(tree.tokens[i] == tree.tokens[2 * i] + tree.tokens[2 * i + 1] for i in range(1, tree.width))


def test_small_edit_touches_little(counter):
    text = " ".join(f"word{i}" for i in range(20000))
    tree = plant(text, counter)
    _, n = tc.edit(text, tree, len(text) // 2, 3, "abc", counter)
    assert n < 12


def test_columns(spark, make, whole):
    rows = [(1, "hello world, it's me"), (2, ""), (3, None), (None, "a b"), (1, "hello world, it's me"), (4, "word " * 5000)]
    trees = tc.build_trees(make(rows))
    edits = spark.createDataFrame(
        [(1, 2, 0, 0, "Oh! "), (1, 1, 5, 6, "'re"), (2, 1, 9, 9, "new"), (4, 1, 12000, 3, None), (4, 2, None, None, "x")],
        "doc_id bigint, seq int, at int, cut int, put string",
    )
    joined = trees.join(tc.gather_edits(edits), "doc_id", "left")
    got = sorted(((r.doc_id, r.text, r.tokens_before, r.tokens_after) for r in tc.apply_edits(joined).collect()), key=str)
    count = lambda t: len(whole.encode_ordinary(t))
    long = "word " * 5000
    after = {1: "Oh! hello're, it's me", 2: "new", 3: "", None: "a b", 4: "x" + long[:12000] + long[12003:]}
    assert got == sorted([(i, after[i], count(t or ""), count(after[i])) for i, t in rows], key=str)
    assert tc.build_trees(make([])).count() == 0


def test_query_counts(spark, whole):
    from corvane.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op9_edited_token_counts"](spark, folder).collect()
    assert len(rows) == len(texts)
    assert all(r.tokens_before == len(whole.encode_ordinary(texts[r.doc_id])) for r in rows)
    assert sum(r.encoded_leaves for r in rows) < 0.5 * sum(r.leaves_before for r in rows)


def test_lists_of_a_slice_are_read_in_one_go():
    lists = [[], [1, 2], [3], [], [4, 5, 6], []]
    column = tc._list_array(lists)
    assert column.to_pylist() == lists and column.type == pa.list_(pa.int32())
    assert all(tc._lists(column.slice(i, n)) == lists[i : i + n] for i in range(6) for n in range(1, 7 - i))


def test_counts_are_remembered_up_to_a_limit():
    counter = tc.Counter(open(tc.RANKS, "rb").read(), most=3)
    pieces = ["a", " tokenization", "b", "a", " zzqqx", "b", " tokenization"]
    want = [len(counter.encoding.encode_ordinary(p)) for p in pieces]
    assert counter.counts(pieces) == want and len(counter.known) <= 3
