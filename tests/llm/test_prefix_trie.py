"""The prefix trie against dictionaries of all prefixes."""

import hashlib
import random
import re
import zlib

import pytest

from corvane.llm import prefix_trie, queries

FOLDER = "/root/testdata/sf0.001"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def plain_turns(rows):
    found = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            found.setdefault(conv, []).append(((turn is not None, turn or 0), (role or "", text or "")))
    return {c: [t for _, t in sorted(ts, key=lambda t: t[0])] for c, ts in found.items()}


def plain_rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        stem = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        out[c] = convs.get(stem, [])[:h] + turns[h:]
    return out


def plain_trie(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved, rows = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[b] for b in below) or 1
        saved[node] = sum(saved[b] for b in below) + (len(members[node]) - 1) * words
        ends = ",".join(map(str, sorted(c for c in members[node] if len(convs[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        rows.append((min(members[node]), len(node), parent, len(members[node]), len(below), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def test_query_against_dictionaries(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(queries.op13_prefix_trie(spark, FOLDER)) == plain_trie(plain_rebuilt(plain_turns(rows)))


@pytest.fixture()
def made(spark, tmp_path):
    def build(rows):
        folder = str(tmp_path / f"t{len(rows)}")
        df = spark.createDataFrame([(*r, b"k", 1, "p") for r in rows], "conv_id bigint, turn bigint, role string, text string, key binary, depth int, path string")
        df.write.parquet(f"{folder}/conversations.parquet")
        return rows_of(queries.op13_prefix_trie(spark, folder))

    return build


def test_odd_rows(made):
    rows = [(c, t, "user" if t % 2 else "bot", f"turn {t} of {c % 3}\n  x") for c in range(45) for t in range(c % 6 + 1)]
    rows += [(60, None, None, None), (60, 1, "user", ""), (60, 0, "", "user"), (61, -5, "u", "a b"), (61, 7, "u", None), (-21, 0, "u", "a"), (-20, 0, "u", "b")]
    rows += [(None, 0, "user", "lost"), (100, 0, "a", "bc"), (101, 0, "ab", "c"), (140, 0, "r", "t"), (140, 1, "r", "t"), (140, 2, "r", "t")]
    assert made(rows) == plain_trie(plain_rebuilt(plain_turns(rows)))


def test_no_rows(made):
    assert made([]) == []


def test_only_turnless_conversations(made):
    rows = [(22, 0, "u", "x")]  # its three first turns are those of conversation 20, which is not there
    assert zlib.crc32(b"22") % 4 > 0 and made(rows) == plain_trie({22: []})


def test_members_of_a_large_node_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "RUN", 7)
    convs = {c: [("u", "same")] * (1 + (c % 50 == 0)) for c in range(-40, 900)}
    rows = spark.createDataFrame([(c, i, *t) for c, ts in convs.items() for i, t in enumerate(ts)], "conv_id bigint, turn int, role string, text string")
    assert rows_of(prefix_trie.conversation_trie(prefix_trie.conversations(rows))) == plain_trie(convs)


def test_a_deep_conversation_and_long_texts(spark):
    deep = [("u", f"t{i} " * (1 + 20_000 * (i == 3))) for i in range(30)]
    convs = {1: deep, 2: deep[:17], 3: deep[:17] + [("u", "other")]}
    rows = spark.createDataFrame([(c, i, *t) for c, ts in convs.items() for i, t in enumerate(ts)], "conv_id bigint, turn int, role string, text string")
    assert rows_of(prefix_trie.conversation_trie(prefix_trie.conversations(rows))) == plain_trie(convs)


@pytest.mark.parametrize("together, deep", [(0, 10), (300, 30), (1 << 17, 140)])
def test_rounds_of_many_levels_and_of_one(spark, together, deep):
    rng = random.Random(9)
    convs = {c: [(str(rng.randrange(2)), f"w{rng.randrange(2)}") for _ in range(rng.choice((0, 2, 5, 9)))] for c in range(60)}
    stem = [("u", f"s {i}") for i in range(deep)]
    convs |= {100 + c: stem[: rng.randrange(deep + 1)] + [("x", str(rng.randrange(2)))] * rng.randrange(4) for c in range(40)}
    rows = [(c, i, *t) for c, ts in convs.items() for i, t in enumerate(ts)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    trie = prefix_trie.conversation_trie(prefix_trie.conversations(df), together)
    assert rows_of(trie) == plain_trie({c: t for c, t in convs.items() if t})
