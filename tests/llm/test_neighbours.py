"""Multiprobe search against exact search."""

import math

import numpy as np
import pytest

from corvane.llm.neighbours import fit_index, nearest_neighbours, probe_order, usable


def exact(rows, queries, k=10):
    out = {}
    for q, v in queries:
        near = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(v, x))), i) for i, x in rows if i != q)
        out[q] = near[:k]
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, rank int")


def test_recall_on_a_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    asked = table.filter("vec_id % 10 = 0")
    rows = [(r.vec_id, [float(v) for v in r.embedding]) for r in table.collect()]
    want = exact(rows, [r for r in rows if r[0] % 10 == 0])
    got = {}
    for r in nearest_neighbours(table, asked).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.score, r.vec_id)
    hits = 0
    points = dict(rows)
    for q, near in want.items():
        assert sorted(got[q]) == list(range(1, 11))
        assert [got[q][i] for i in range(1, 11)] == sorted(got[q].values())
        for score, i in got[q].values():
            assert score == pytest.approx(math.dist(points[q], points[i]), abs=1e-12)
        hits += len({i for _, i in near} & {i for _, i in got[q].values()})
    assert hits >= 0.9 * 10 * len(want)


def test_ties_nulls_and_few_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [None, 1.0]), (7, [nan, 1.0])]
    rows += [(8, [inf, 1.0]), (9, [1.0]), (None, [1.0, 0.0]), (1, [1.0, 0.0])]
    table = frame(spark, [(*r, 1) for r in rows])
    got = [tuple(r) for r in nearest_neighbours(table, table.filter("vec_id in (0, 4, 5)")).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 0.0), (0, 2, 1, 0.0), (0, 3, 2, 0.0), (0, 4, 3, math.sqrt(2))]
    many = frame(spark, [(i, [1.0, 2.0], 1) for i in range(500)])
    got = [tuple(r) for r in nearest_neighbours(many, many.filter("vec_id = 100")).orderBy("rank").collect()]
    assert got == [(100, i + 1, i, 0.0) for i in range(10)]
    assert nearest_neighbours(table.limit(0), table).count() == 0
    assert nearest_neighbours(table, table.limit(0)).count() == 0


def test_blocks_agree(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    index = fit_index(usable(table, "vec_id", "embedding"), 10)
    asked = table.filter("vec_id % 7 = 0")
    one = nearest_neighbours(table, asked, index=index)
    many = nearest_neighbours(table, asked, index=index, block=9)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


def test_probe_order():
    order = probe_order(4, 30)
    assert order[0] == () and len(set(order)) == len(order) == 30
    assert all(len(p) == len({min(r, 9 - r) for r in p}) for p in order)
    cost = np.array([0] + [j * (j + 1) / 120 for j in range(1, 5)] + [1 - (9 - j) / 5 + (9 - j) * (10 - j) / 120 for j in range(5, 9)])
    totals = [round(float(sum(cost[r] for r in p)), 9) for p in order]
    assert totals == sorted(totals)
