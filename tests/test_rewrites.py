"""Packed JSON, delimited files, vertex vectors, merged reports and sketches."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.operators import aggregates, chunking, graph, graph_algorithms
from corvane.sources import documents


def leaves(value, path=()):
    inner = list(enumerate(value)) if isinstance(value, list) else list(value.items()) if isinstance(value, dict) else []
    return {k: v for key, child in inner for k, v in leaves(child, (*path, str(key))).items()} if inner else {path: value}


def made(rng, depth=0):
    kind = rng.random()
    if depth > 4 or kind < 0.4:
        return rng.choice([None, True, 1.5, "x" * rng.randrange(30), "é\n\"", {}, []])
    size = rng.randrange(1, 6)
    return [made(rng, depth + 1) for _ in range(size)] if kind < 0.6 else {f"k{i}": made(rng, depth + 1) for i in range(size)}


@pytest.mark.parametrize("seed", range(12))
def test_packed_json_keeps_every_leaf(seed):
    rng = random.Random(seed)
    value = {"a": made(rng), "b": made(rng), "c": [made(rng) for _ in range(8)]}
    most, least = 160, 60
    texts = chunking._json_chunks(json.dumps(value), most, least)
    merged = {}
    for text in texts:
        part = leaves(json.loads(text))
        assert not merged.keys() & part.keys()
        merged |= part
    assert merged == leaves(value)
    rows = chunking._json_rows(value)
    assert all(len(t) <= 2 * most or len(leaves(json.loads(t))) == 1 for t in texts) and [r[0] for r in rows] == list(merged)


def test_json_lines_are_decided_by_all_lines():
    good = [json.dumps({"n": i}) for i in range(40)]
    assert len(chunking._json_chunks("\n".join(["no"] * 10 + good), 100, 10)) == 40
    assert chunking._json_chunks("\n".join(["no"] * 11 + good), 100, 10) == []
    assert chunking._json_chunks("\n".join(good[:9] + ["no"] * 9), 100, 10) == []


def test_delimited_files_with_a_header_each(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("x\ty\n1\t2\nx\ty\n\n3\n")
    (tmp_path / "b.tsv").write_text("x\ty\n5\t\n")
    (tmp_path / "c.tsv").write_text("other\n7\t8\n")
    rows, rejected = documents.read_delimited(spark, str(tmp_path))
    assert sorted(map(tuple, rows.collect())) == [("1", "2"), ("5", ""), ("x", "y")]
    assert sorted(r.value for r in rejected.collect()) == ["3", "7\t8", "other"]


def test_vertices_of_one_neighbourhood_have_like_vectors(spark):
    rng = random.Random(2)
    edges = {(f"{side}{rng.randrange(20)}", f"{side}n{rng.randrange(6)}", float(rng.randint(1, 4))) for side in "ab" for _ in range(150)}
    df = spark.createDataFrame(list(edges) + [("alone", "alone", 1.0)], "src string, dst string, weight double")
    vectors = {r.name: np.array(r.vector) for r in graph_algorithms.node_embeddings(df, dim=48).collect()}
    assert "alone" not in vectors and all(abs(np.linalg.norm(v) - 1) < 1e-9 for v in vectors.values())
    cos = lambda x, y: float(vectors[x] @ vectors[y])
    names = sorted(vectors)
    same = [cos(x, y) for x in names for y in names if x < y and x[0] == y[0] and ("n" in x) == ("n" in y)]
    other = [cos(x, y) for x in names for y in names if x < y and x[0] != y[0]]
    assert np.mean(same) > np.mean(other) + 0.3


def test_merged_sketches_are_those_of_all_rows(spark):
    rows = spark.range(20_000).select(
        F.expr("timestamp'2024-01-01' + make_dt_interval(0, cast(id % 240 as int))").alias("created_at"), (F.col("id") % 3000).alias("user_id"), (F.col("id") % 101).cast("double").alias("duration")
    )
    merged = aggregates.merge_usage(aggregates.usage_sketches(rows), F.lit("all"), (50,)).first()
    assert merged.pv == 20_000 and abs(merged.users - 3000) < 4 * 1.04 / 64 * 3000 and abs(merged.p50 - 50) <= 3


def test_lists_of_both_graphs_stand_in_order(spark):
    vertices = lambda d: spark.createDataFrame([("a", "T", d)], "name string, type string, description string")
    edges = lambda d, k, w: spark.createDataFrame([("a", "b", w, d, k)], "src string, dst string, weight double, description string, keywords array<string>")
    _, merged = graph.merge_graphs((vertices("x"), edges("x", ["k2", "k1"], 1.0)), (vertices("y"), edges("y", ["k1"], 2.0)))
    (row,) = merged.collect()
    assert (row.weight, row.description, row.keywords, row.changed) == (3.0, "x<SEP>y", ["k2", "k1", "k1"], True)
