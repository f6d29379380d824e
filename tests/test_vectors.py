"""Mean vectors, clusters of a dataset and vector cells against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.operators import cluster, retrieval, vector_cells


def blobs(n, k, d=6, seed=2, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (k, d)) * 3
    return centres[rng.integers(0, k, n)] + rng.normal(0, spread, (n, d))


def rows_of(spark, points):
    return spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id int, vector array<double>").repartition(3)


def test_mean_vectors(spark):
    rng = np.random.default_rng(1)
    data = [(int(k), None if k % 5 == 0 else str(k % 3), rng.normal(0, 1, 4).tolist() if i % 11 else None) for i, k in enumerate(rng.integers(0, 40, 900))]
    df = spark.createDataFrame(data, "a int, b string, vector array<double>").repartition(5)
    got = {(r.a, r.b): np.array(r.vector) for r in cluster.mean_vectors(df, ["a", "b"]).collect()}
    want = {}
    for a, b, v in data:
        if v is not None:
            want.setdefault((a, b), []).append(v)
    assert got.keys() == want.keys()
    assert all(np.allclose(got[k], np.mean(want[k], axis=0)) for k in want)
    plan = cluster.mean_vectors(df, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan


def test_mean_vectors_of_one_key_and_none(spark):
    df = rows_of(spark, blobs(200, 3)).withColumn("k", F.lit(7))
    (row,) = cluster.mean_vectors(df, ["k"]).collect()
    assert row.k == 7 and np.allclose(row.vector, blobs(200, 3).mean(axis=0))
    assert cluster.mean_vectors(df.limit(0), ["k"]).count() == 0


@pytest.mark.parametrize("n", [1, 2, 40, 511, 513])
def test_clusters_of_a_dataset_are_its_groups(spark, n):
    rng = np.random.default_rng(n)
    points = 10 * np.eye(6)[np.arange(n) % 4] + rng.normal(0, 0.05, (n, 6))
    labels = {r.id: r.cluster for r in cluster.cluster_dataset(rows_of(spark, points), 8).collect()}
    near = ((points[:, None, :] - points[None]) ** 2).sum(axis=2) < 1
    found = np.array([labels[i] for i in range(n)])
    if n >= 40:
        assert ((found[:, None] == found[None]) == near).all()
    assert set(found) == set(range(found.max() + 1))


def test_equal_vectors_are_one_cluster(spark):
    assert {r.cluster for r in cluster.cluster_dataset(rows_of(spark, np.ones((50, 3))), 8).collect()} == {0}
    assert cluster.cluster_dataset(rows_of(spark, np.ones((1, 3))).limit(0), 8).count() == 0


def test_ward_by_key(spark):
    points = np.concatenate([blobs(30, 2, seed=3), blobs(30, 3, seed=4)])
    df = rows_of(spark, points).withColumn("doc", F.floor(F.col("id") / 30))
    got = {r.id: (r.doc, r.cluster) for r in cluster.cluster_ward(df, 8, "doc").collect()}
    for doc in (0, 1):
        mine = points[doc * 30 : doc * 30 + 30]
        want = cluster._ward_labels(mine, 8)
        assert [got[doc * 30 + i] for i in range(30)] == [(doc, w) for w in want]


@pytest.fixture(scope="module")
def stored(spark):
    rng = np.random.default_rng(9)
    points = np.concatenate([blobs(1500, 30, d=16, spread=0.4), rng.normal(0, 1, (300, 16)), np.ones((400, 16)), np.zeros((2, 16))])
    vectors = spark.createDataFrame([(f"c{i}", p.tolist()) for i, p in enumerate(points)] + [("none", None), ("empty", [])], "chunk_id string, embedding array<double>")
    queries = spark.createDataFrame([(i, (points[i * 37] + rng.normal(0, 0.2, 16)).tolist()) for i in range(40)], "query_id int, vector array<double>")
    return vectors, queries, vector_cells.build_cells(vectors.repartition(4), 40, part_rows=100)


def ranked(df):
    return sorted((r.query_id, r.rank, r.chunk_id, round(r.score, 6)) for r in df.collect())


@pytest.mark.parametrize("topn, least", [(1, -1.0), (10, -1.0), (10, 0.9), (700, -1.0)])
def test_without_probes_cells_are_exact(stored, topn, least):
    vectors, queries, store = stored
    whole = vectors.filter("size(embedding) > 0")
    assert ranked(vector_cells.cell_match(queries, store, topn, least, tile_rows=16)) == ranked(retrieval.vector_match(queries, whole, topn, least))


def test_probes_fill_their_lists_and_find_most(stored):
    vectors, queries, store = stored
    exact = {r[:1] + r[2:3] for r in ranked(retrieval.vector_match(queries, vectors.filter("size(embedding) > 0"), 10))}
    near = ranked(vector_cells.cell_match(queries, store, 10, probes=8))
    assert len(near) == 400 and len(exact & {r[:1] + r[2:3] for r in near}) >= 0.95 * len(exact)
    long = ranked(vector_cells.cell_match(queries, store, 2202, probes=1))
    assert len(long) == 40 * 2202


def test_probes_prune_folders_and_parts_are_bounded(spark, stored):
    _, queries, store = stored
    assert store.parts.max() >= 4 and store.sizes.sum() == 2202
    cells = [int(c) for c in np.flatnonzero(store.sizes)[:2]]
    plan = store.rows.filter(F.col("cell").isin(cells))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell" in plan
    biggest = store.rows.groupBy("cell", "part").count().agg(F.max("count")).first()[0]
    assert biggest < 400
