"""Mentions and the pairs that meet in a sentence: texts stay in their rows, and rows are dealt out once."""

import random
import re
from itertools import product

import pytest
from pyspark.sql import functions as F

from corvane.operators import graph


def texts():
    rng = random.Random(2)
    words = ["Alpha", "ALPHA", "Beta", "Gammas", "alpha", "the", "of", "Straße", "Delta"]
    rows = [(f"c{i}", "".join(rng.choice(words) + rng.choice([" ", " ", ". ", "\n", "!? "]) for _ in range(rng.randint(0, 25)))) for i in range(40)]
    return [*rows, ("none", None), ("empty", ""), ("small", "no names. at all")]


def brute(rows):
    out = {}
    for key, text in rows:
        for at, sentence in enumerate(re.split(r"[.!?;\n]+", text or "")):
            for word in re.findall(r"[A-Z][a-zA-Zß]{3,}", sentence):
                name = word.upper()
                out.setdefault((key, name), (at, text.upper().count(name)))
    return out


def exchanges(df):
    return df._jdf.queryExecution().sparkPlan().toString().count("REPARTITION"), df._jdf.queryExecution().optimizedPlan().toString()


def test_mentions_are_counted_in_their_rows(spark):
    chunks = spark.createDataFrame(texts(), "chunk_id string, content string")
    found = graph.mentions(chunks)
    assert {(r.chunk_id, r.name): (r.sentence, r.occurrences) for r in found.collect()} == brute(texts())
    dealt, plan = exchanges(found)
    assert dealt == 1 and "_upper" not in plan.split("Repartition")[0]


@pytest.mark.parametrize("distance", [0, 1, 2])
def test_pairs_meet_in_their_rows(spark, distance):
    mentions = brute(texts())
    chunks = spark.createDataFrame(texts(), "chunk_id string, content string")
    pairs = graph.cooccurrence(graph.mentions(chunks), distance, fixed_weight=None)
    total = {}
    for (key, _), (_, n) in mentions.items():
        total[key] = total.get(key, 0) + n
    expected = {
        (k, a, b): round(max((n + m) / total[k], 0.01), 9)
        for ((k, a), (x, n)), ((j, b), (y, m)) in product(mentions.items(), repeat=2)
        if k == j and a < b and abs(x - y) <= distance
    }
    rows = pairs.select("chunk_id", "src", "dst", F.round("weight", 9).alias("w")).collect()
    assert {(r.chunk_id, r.src, r.dst): r.w for r in rows} == expected and len(rows) == len(expected)
    assert "Join" not in exchanges(pairs)[1]
