"""Quality rules, mixing and sharding against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corvane.llm import mixing, quality, sharding
from corvane.llm.queries import QUERIES

from .brute import words

FOLDER = "/root/testdata/sf0.001"
ODD = [None, "", " \n\t", "one", "a b a b a b", "x y z\nx y z\n\nx y z\n \n ", "# $ & | < >%*", "é ü x 漢字 🙂", "a b c a b c d a b", "w " * 70000, "\x0b\x0c a\r\nb"]


def plain_counts(text):
    own = words(text)
    seen = Counter(tuple(own[i : i + 3]) for i in range(len(own) - 2))
    covered = set()
    for i in range(len(own) - 2):
        if seen[tuple(own[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(own), sum(map(len, own)), len(re.findall("[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_quality_counts(spark, make):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    rows = list(enumerate(ODD)) + [(1, "one two"), (None, "x")] + [(100 + r.doc_id, r.text) for r in table]
    got = sorted((tuple(r) for r in quality.judge_quality(make(rows)).select("doc_id", *COUNTS, "base_failed").collect()), key=str)
    want = [(i, *plain_counts(t)) for i, t in rows]
    want = sorted(((*w, w[1] < 50 or 100 * w[5] > 50 * w[1]) for w in want), key=str)
    assert got == want
    assert quality.judge_quality(make([])).count() == 0


def test_every_language_has_its_reference(spark):
    """More languages than 512, of three scripts, with three like texts each: none is far from the two others."""
    rows = []
    for i in range(530):
        say = ("abcdefgh", "абвгдежз", "12345678")[i % 3]
        text = " ".join(say[k % 7 :] + say[k % 5 :] + say[k // 8] for k in range(60)) + " " + " ".join(say[k % 8] + say[k // 8] for k in range(60))
        rows += [(3 * i + j, f"{text} {text} {text} {text} {text} {say[j]}", f"l{i}") for j in range(3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = quality.judge_quality(docs, most_repeated=100).collect()
    assert len(got) == 1590 and all(r.kept for r in got)
    assert max(r.class_distance for r in got) < 0.02 and max(r.word_distance for r in got) < 0.1


def test_a_text_is_no_part_of_its_own_reference(spark):
    prose = " ".join(f"word{chr(97 + i % 26)} and the other, thing." for i in range(400))
    rows = [(i, prose, "en") for i in range(4)] + [(10, "#$% &&* <|> " * 100, "alone"), (11, prose, "lone prose"), (12, "", "empty")]
    got = {r.doc_id: r for r in quality.judge_quality(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), most_repeated=100).collect()}
    assert not got[10].kept and got[10].class_distance > 0.9 and got[10].word_distance is None
    assert got[11].kept and got[11].word_distance is None and all(got[i].kept for i in range(4)) and not got[12].kept


def test_long_words_count(spark):
    rows = [(i, " ".join(["extraordinarily", "commonplace", "words"] * 200 + [f"w{i}x{k}" for k in range(60)]), "en") for i in range(5)]
    rows.append((9, " ".join(f"x{k}y" for k in range(700)), "en"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r.doc_id: r.word_distance for r in quality.judge_quality(docs, most_repeated=100).collect()}
    assert max(got[i] for i in range(5)) < 0.5 and got[9] > 0.8


def test_common_words_are_exact_in_crowded_buckets(spark):
    rng = random.Random(4)
    said = [(r, f"w{min(rng.randrange(300), rng.randrange(300))}") for r in ("a", "b") for _ in range(4000)] + [("c", "one")]
    tokens = spark.createDataFrame(said, "_ref string, _word string")
    got = sorted((r._ref, r._word, r._count) for r in quality.common_words(tokens, 6, buckets=40).collect())
    want = []
    for ref in "abc":
        seen = Counter(w for r, w in said if r == ref)
        want += [(ref, w, n) for w, n in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:6]]
    assert got == sorted(want)


def test_quality_against_labels(spark):
    folder = "/root/testdata/sf0.01"
    judged = QUERIES["op2_quality_divergence"](spark, folder)
    rows = judged.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("not base_failed").collect()
    good, bad = [r.kept for r in rows if r.quality], [r.kept for r in rows if not r.quality]
    assert all(good) and sum(bad) <= 0.2 * len(bad)


def test_mixing(spark, make):
    draws = [{"source": s, "size": n} for s, n in (("a", 1000), ("b", 10), (None, 500), ("c", 3000), ("d", 0))]
    targets = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(draws, "source string, size bigint")).collect()}
    total = sum(d["size"] for d in draws)
    assert sum(targets.values()) == pytest.approx(1.5 * total)
    level = max(targets[s] / w for s, w in (("a", 5), ("b", 2), ("c", 1), ("d", 5), (None, 2)))
    for d, w in zip(draws, (5, 2, 2, 1, 5)):
        assert targets[d["source"]] == pytest.approx(min(2 * d["size"], w * max(targets["c"], 0))) or targets[d["source"]] == 2 * d["size"]
    assert level >= targets["c"]


def test_mixing_rows(spark, make):
    rows = [(i, "w " * (i % 50)) for i in range(3000)] + [(7, "w " * 7), (None, None), (None, "a b")]
    docs = make(rows).withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").when(F.col("doc_id") % 3 == 1, F.lit(None)).otherwise("b"))
    mixed = mixing.mix_sources(docs, F.size(mixing.words_of("text")))
    found = mixed.collect()
    assert len(found) == len(rows) and all(0 <= r.mix_copies <= 2 for r in found)
    taken, target = defaultdict(int), {}
    for r in found:
        taken[r.source] += r.mix_size * r.mix_copies
        target[r.source] = r.mix_target
    for s, n in taken.items():
        assert n == pytest.approx(target[s], rel=0.1)
    copies = Counter((r.doc_id, r.text) for r in mixing.emit_copies(mixed).collect())
    want = Counter()
    for r in found:
        want[r.doc_id, r.text] += r.mix_copies
    assert copies == +want
    assert mixing.emit_copies(mixed).columns == docs.columns
    assert mixing.mix_sources(make([]), F.size(mixing.words_of("text"))).count() == 0


def check_shards(df, rows, shards=24, slack=None):
    found = df.collect()
    assert sorted((r.doc_id, r.text) for r in found if r.doc_id is not None) == sorted((i, t) for i, t in rows if i is not None)
    size = defaultdict(int)
    slots = defaultdict(list)
    for r in found:
        size[r.shard] += len((r.text or "").encode()) + 8
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(shards))
    mean = sum(size.values()) / shards
    largest = max(len((t or "").encode()) + 8 for _, t in rows)
    assert all(abs(size[s] - mean) <= (slack or 0.01 * mean + largest) for s in range(shards))


def test_shards(make):
    rows = [(i, "x" * (i * 37 % 400)) for i in range(3000)]
    check_shards(sharding.shard_by_bytes(make(rows, extra=False)), rows)
    check_shards(sharding.shard_by_bytes(make(rows, extra=False), piece_rows=20), rows)


def test_shards_of_copies(make):
    """A third of the rows are equal in text, and some in id too."""
    rows = [(i, "") for i in range(2000)] + [(5000, "same") for _ in range(1500)] + [(i, f"text {i}") for i in range(3000, 4500)]
    check_shards(sharding.shard_by_bytes(make(rows, extra=False)), rows)


def test_few_rows(make):
    rows = [(1, None), (2, "a"), (3, "a")]
    check_shards(sharding.shard_by_bytes(make(rows, extra=False)), rows, slack=100)
    assert sharding.shard_by_bytes(make([])).count() == 0


def test_shard_query(spark):
    rows = QUERIES["op10_shard_by_bytes"](spark, FOLDER).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {i: (len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in texts.items()}
