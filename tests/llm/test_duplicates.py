"""Near duplicates, repeated passages and fuzzy lines against brute force."""

import random
import time

import numpy as np
import pytest

from corvane.llm import linking
from corvane.llm.lines import drop_lines, fuzzy_lines
from corvane.llm.near_duplicates import near_duplicates
from corvane.llm.queries import QUERIES
from corvane.llm.repeats import repeated_passages

from . import brute


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(3)
    vocabulary = ["".join(draw.choices("abcdefghij", k=draw.randint(1, 7))) for _ in range(400)]
    say = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    passage = say(60)
    out = [None, "", " \n\t ", "one", "One", "two words", "é ü 漢字 ∑   x", "a b c d e", "A B C D E"]
    for size in (20, 80, 300):
        base = say(size)
        out += [" ".join(base)] * 3
        for edits in (1, 2, 4, 9):
            near = list(base)
            for _ in range(edits):
                near[draw.randrange(size)] = draw.choice(vocabulary)
            out.append(" ".join(near))
            out.append("\n".join(" ".join(near[k : k + 15]) for k in range(0, size, 15)))
    for _ in range(20):
        own = say(draw.randint(10, 200))
        cut = draw.randrange(len(own))
        out.append("  ".join(own[:cut] + passage[draw.randint(0, 20) :] + own[cut:]))
    out.append(" ".join(["same"] * 500))
    out.append(" ".join(say(40) + passage + say(3) + passage))
    out.append("\n".join(["line of words that comes again and again here"] * 4 + [" ".join(say(30000))]))
    return list(enumerate(out))


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return docs, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def check_near(df, rows):
    want = brute.near(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(df).collect()}
    assert got == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in near_duplicates(df).collect())


def test_near_duplicates(make, rows):
    check_near(make(rows), rows)


def test_near_duplicates_of_a_table(tables):
    check_near(*tables)


def check_repeats(df, rows):
    got = sorted(tuple(r) for r in repeated_passages(df).collect())
    assert got == brute.repeats(rows)


def test_repeated_passages(make, rows):
    check_repeats(make(rows), rows)


def test_repeated_passages_of_a_table(tables):
    check_repeats(*tables)


@pytest.mark.parametrize(("window", "first"), [(2, 1), (7, 2), (20, 5), (35, 4)])
def test_repeated_passages_at_other_lengths(make, rows, window, first):
    got = sorted(tuple(r) for r in repeated_passages(make(rows[:60]), window=window, first=first).collect())
    assert got == brute.repeats(rows[:60], window)


def test_repeated_rows(make):
    text = " ".join(str(i) for i in range(50))
    rows = [(1, text), (1, text), (2, "x"), (None, "x"), (None, None)]
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in repeated_passages(make(rows)).collect()), key=str)
    assert got == sorted([(1, 50, 50), (1, 50, 50), (2, 1, 0), (None, 1, 0), (None, 0, 0)], key=str)
    near = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates(make(rows)).collect()), key=str)
    assert near == sorted([(1, 1, True), (1, 1, True), (2, 2, True), (None, 2, False), (None, None, True)], key=str)


def check_lines(df, rows):
    got = {(r.doc_id, r.line): (r.first_key, r.first_line) for r in fuzzy_lines(df).collect()}
    assert got == brute.fuzzy_lines(rows)


def test_fuzzy_lines(make, rows):
    check_lines(make(rows), rows)


def test_fuzzy_lines_of_a_table(tables):
    docs, rows = tables
    check_lines(docs.filter("doc_id < 60"), [r for r in rows if r[0] < 60])


def test_every_pair_at_the_threshold(make):
    """Pairs of lines at a similarity of 73/97, each without any other line that is alike."""
    draw = random.Random(9)
    rows = []
    for i in range(400):
        line = "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=90))
        rows += [(2 * i, line), (2 * i + 1, line[:30] + "0" + line[31:60] + "0" + line[61:])]
    missed = [r.doc_id for r in fuzzy_lines(make(rows)).collect() if r.first_key != r.doc_id - r.doc_id % 2]
    assert missed == []


def test_short_lines(spark, make, tmp_path):
    rows = [(1, "Subscribe to our newsletter!"), (2, "Subscribe to our newsletter."), (3, "aaaaaa"), (4, "aaaaaaa"), (5, "abc"), (6, "abd")]
    make(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.first_key, r.first_line) for r in QUERIES["op8_fuzzy_lines"](spark, str(tmp_path)).collect()}
    assert got == {1: (1, 0), 2: (1, 0), 3: (3, 0), 4: (3, 0), 5: (5, 0), 6: (6, 0)}
    lines = brute.fuzzy_lines(rows, min_bytes=0)
    assert got == {i: lines[i, 0] for i, _ in rows}


def test_texts_of_rows_without_key(make):
    draw = random.Random(4)
    say = lambda n: " ".join("".join(draw.choices("abcdefgh", k=5)) for _ in range(n))
    a, b = say(60), say(60)
    rows = [(None, a), (3, a), (4, a + " more"), (None, b), (5, b + " more"), (None, say(40))]
    got = sorted((r.doc_id or 0, r.first_key) for r in fuzzy_lines(make(rows)).collect() if r.first_key)
    assert got == [(0, 3), (0, 5), (3, 3), (4, 3), (5, 5)]
    near = sorted((r.doc_id or 0, r.component_id) for r in near_duplicates(make(rows)).collect() if r.component_id)
    assert near == got


def test_drop_lines(make):
    rows = [(1, "a first line\n\nanother one"), (2, "another one"), (3, "another one\nnew"), (4, None), (5, "")]
    docs = make(rows)
    left = {r.doc_id: r.text for r in drop_lines(docs, fuzzy_lines(docs)).collect()}
    assert left == {1: rows[0][1], 3: "new", 4: None, 5: ""}


def test_empty_tables(make):
    none = make([])
    assert near_duplicates(none).count() == 0
    assert repeated_passages(none).count() == 0
    assert fuzzy_lines(none).count() == 0


def test_members_from_one_exchange(spark):
    rng = np.random.default_rng(3)
    bands = rng.integers(-400, 400, (3000, 3)) << 16
    rows = [(int(i), int(i) % 50, [int(b) for b in bs]) for i, bs in zip(rng.integers(0, 900, 3000), bands)]
    rows += [(10_000 + i, 5, [99 << 40]) for i in range(25_000)]  # a bucket over several batches
    rows += [(1, 1, [])] + [(77, 27, [12345 << 16])] * 3
    items = spark.createDataFrame(rows, "item bigint, size bigint, bands array<bigint>").repartition(3)
    plain = lambda df, bits: sorted((r.band >> bits, r.item, r.size, r.low) for r in df.collect())
    found = plain(linking.sorted_members(items), 0)
    assert found == plain(linking.bucket_members(items), 16) and len(found) > 26_000


def test_members_in_lots_of_bands(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(int(i), int(i) % 50, [int(b) for b in bs]) for i, bs in zip(rng.integers(0, 900, 2000), rng.integers(0, 300, (2000, 7)) * 8 + np.arange(7) << 16)]
    items = spark.createDataFrame([*rows, (5000, 1, [])], "item bigint, size bigint, bands array<bigint>").repartition(3)
    sent = []
    cut = linking.cut_lineage
    monkeypatch.setattr(linking, "cut_lineage", lambda df: sent.append(cut(df)) or sent[-1])
    plain = lambda df: sorted((r.band, r.item, r.size, r.low) for r in df.collect())
    lots = plain(linking.sorted_members(items, 7, at_once=3))
    assert len(sent) == 3 and len(lots) > 10_000
    assert lots == plain(linking.sorted_members(items))
    assert {b % 8 for b in (r.band for r in sent[0].collect())} == {0, 1, 2}


def test_what_is_shuffled_for_a_stored_table_goes(spark):
    from corvane.session import cut_lineage

    kept = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").count("shuffle_")
    before = kept()
    assert cut_lineage(spark.range(5000).repartition(3, "id")).columns == ["id"]
    for _ in range(100):
        if kept() <= before:
            break
        time.sleep(0.1)
    assert kept() <= before


def test_groups_leave_one_table_behind(spark, make, rows):
    """What is written on the way to the groups, and the bands of the lines, do not stay on the disk."""
    from pathlib import Path

    from corvane.session import shared_folder

    folder = Path(shared_folder(spark).removeprefix("file:"))
    tables = lambda: {p.name for p in folder.glob("corvane-*")}
    before = tables()
    got = fuzzy_lines(make(rows))
    read = {name for name in tables() - before if name in "\n".join(got.inputFiles())}
    assert tables() - before == read and len(read) == 3
    left = [spark.read.parquet(str(folder / name)).columns for name in read]
    assert sorted(len(c) for c in left) == [2, 3, 4] and not any("bands" in c for c in left)


def test_union_find_keeps_the_last_round_only(spark, monkeypatch):
    sent = []
    cut = linking.cut_lineage
    monkeypatch.setattr(linking, "cut_lineage", lambda df: sent.append(cut(df)) or sent[-1])
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a bigint, b bigint")
    got = {r.item: r.group for r in linking.union_find(chain).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    from pathlib import Path

    there = [Path(df.inputFiles()[0].removeprefix("file:").replace("///", "/")).exists() for df in sent]
    assert len(there) > 4 and there == [False] * (len(there) - 1) + [True]


def test_a_chain_of_small_buckets_is_no_square_of_blocks(spark, monkeypatch):
    """In a large cloud small buckets give pairs and large ones blocks; links are those of all pairs that share a bucket."""
    draw = np.random.default_rng(4)
    texts = {i: " ".join(f"w{w}" for w in draw.integers(0, 9, 9)) for i in range(300)}
    bands = [(b, i) for b in range(290) for i in range(b, b + 3)] + [(1000, i) for i in range(40)] + [(1001, i) for i in range(30, 80)]
    bands += [(2000, 500), (2000, 501)]
    texts |= {500: texts[0], 501: texts[0] + " more"}
    shingles = lambda part: linking_sets(part)
    from corvane.llm.near_duplicates import shingle_sets

    linking_sets = lambda part: shingle_sets(part, 1)
    sets = {i: set(t.split()) for i, t in texts.items()}
    by = {}
    for b, i in bands:
        by.setdefault(b, set()).add(i)
    pairs = {(x, y) for held in by.values() for x in held for y in held if x < y}
    alike = {(x, y) for x, y in pairs if 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y])}
    every = {(x, y) for x in texts for y in texts if x < y and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y])}

    def groups(links):
        group = {i: i for i in texts}
        while any(group[x] != group[y] for x, y in links):
            for x, y in links:
                group[x] = group[y] = min(group[x], group[y])
        return group

    all_linked = groups(every)
    members = spark.createDataFrame([(b, i, len(sets[i]), min(by[b])) for b, i in bands], "band bigint, item bigint, size bigint, low bigint")
    table = spark.createDataFrame(list(texts.items()), "item bigint, text string")
    monkeypatch.setattr(linking, "BLOCK_ITEMS", 8)
    dealt, paired = [], []
    clouds, checked = linking.check_clouds, linking.check_pairs
    monkeypatch.setattr(linking, "check_clouds", lambda c, *rest: dealt.append(c.agg({"blocks": "sum"}).first()[0] or 0) or clouds(c, *rest))
    monkeypatch.setattr(linking, "check_pairs", lambda p, *rest: paired.append(p.count()) or checked(p, *rest))
    found = {r.item: r.group for r in linking.link_items(members, lambda wanted: table.join(wanted, "item"), shingles, 75, lambda m: m).collect()}
    assert len(alike) > 100 and all(found[x] == found[y] for x, y in alike)
    assert all(all_linked[i] == all_linked[g] for i, g in found.items())
    assert len(dealt) == 2 and len(paired) == 2 and sum(dealt) <= 2 + 80 * 10 < 300 * 38 and paired[1] <= 3 * 290


def test_two_blocks_compare_each_pair_once():
    """Two blocks that meet compare their sets across; what a block has within is compared where it meets itself."""
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 30)).astype(np.uint64)) for _ in range(40)]
    sets += [np.unique(rng.integers(60, 5000, 30).astype(np.uint64)) for _ in range(40)]
    sets = [sets[i] for i in rng.permutation(80)]
    values, bounds = np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    exact = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    assert (linking._meet(values, bounds) * (1 - np.eye(80)) == exact * (1 - np.eye(80))).all()
    across = linking._meet(values, bounds, 33)
    assert across.shape == (33, 47) and (across == exact[:33, 33:]).all()
