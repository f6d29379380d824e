"""The stored graph against rebuilding it, replays and unfinished increments; ranks over ranges; deep folders."""

import random

import pytest
from pyspark.sql import functions as F

from corvane.operators import aggregates, graph_algorithms, scans
from corvane.streaming.graph_state import GraphStore


def mentions(spark, rows):
    return spark.createDataFrame(rows, "src string, dst string, weight double, description string")


def test_increments_equal_a_rebuild(spark, tmp_path):
    rng = random.Random(3)
    store = GraphStore(spark, str(tmp_path / "g"), cuts=3, tolerance=1e-7, stride=20)
    seen = []
    for n, (names, count) in enumerate((("abcdefgh", 12), ("abcxyz", 6))):
        batch = [(rng.choice(names), rng.choice(names), float(rng.randint(0, 3)), f"d{n}") for _ in range(count)] + [(None, "a", 1.0, "lost")]
        store.apply(mentions(spark, batch), n)
        seen += [(min(s, d), max(s, d), w) for s, d, w, _ in batch if s is not None]
    edges = spark.createDataFrame(seen, "src string, dst string, weight double").groupBy("src", "dst").agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("mentions"))
    assert sorted(map(tuple, store.edges().collect())) == sorted(map(tuple, edges.collect()))
    names = edges.select(F.explode(F.array("src", "dst")).alias("name")).distinct()
    linked = edges.filter("weight > 0")
    want = {r.name: r.pagerank for r in graph_algorithms.pagerank(names, linked, tolerance=1e-11).collect()}
    alone = names.join(linked.select(F.explode(F.array("src", "dst")).alias("name")).distinct(), "name", "left_anti").count()
    got = {r.name: r.pagerank for r in store.ranks().collect()}
    if not alone:
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-6) for k in want)
    before = sorted(map(tuple, store.ranks().collect())), sorted(map(tuple, store.edges().collect())), store.texts().count()
    store.apply(mentions(spark, batch), 1)  # the last increment comes again
    after = sorted(map(tuple, store.ranks().collect())), sorted(map(tuple, store.edges().collect())), store.texts().count()
    assert before[1:] == after[1:] and [r[0] for r in before[0]] == [r[0] for r in after[0]]
    assert all(x[1] == pytest.approx(y[1], abs=1e-9) for x, y in zip(before[0], after[0]))


def test_an_increment_without_manifest_is_not_seen(spark, tmp_path, monkeypatch):
    store = GraphStore(spark, str(tmp_path / "g"), cuts=2, stride=20)
    store.apply(mentions(spark, [("a", "b", 1.0, "x")]), 0)
    monkeypatch.setattr(GraphStore, "_pushed", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        store.apply(mentions(spark, [("a", "c", 5.0, "y")]), 1)
    assert [tuple(r) for r in store.edges().collect()] == [("a", "b", 1.0, 1)] and store.texts().count() == 1
    assert {r.name: round(r.pagerank, 5) for r in store.ranks().collect()} == {"a": 0.5, "b": 0.5}


def test_ranks_over_ranges(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, "x", "y"]), rng.choice([1, 1, 1, 2, None]), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, v int, i int").repartition(5)
    got = scans.ranked(df, ["k"], [F.col("v").desc_nulls_last(), "i"], "rank", ranges=7).collect()
    place, want = {}, []
    for k, v, i in sorted(rows, key=lambda r: (str(r[0]), -(r[1] if r[1] is not None else -9), r[2])):
        place[k] = place.get(k, 0) + 1
        want.append((k, v, i, place[k]))
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))


def test_equal_rows_of_one_key_are_dealt_evenly(spark, monkeypatch):
    cuts = []
    real = scans.cut_lineage
    monkeypatch.setattr(scans, "cut_lineage", lambda df: (cuts.append(real(df)), cuts[-1])[1])
    df = spark.range(8000).select(F.lit("one").alias("k"), F.lit(7).alias("v"))
    ranks = sorted(r["rank"] for r in scans.ranked(df, ["k"], ["v"], ranges=8).collect())
    assert ranks == list(range(1, 8001))
    sizes = [r["count"] for r in cuts[-1].groupBy("_range").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1500


def test_a_chain_of_ten_thousand_folders(spark):
    n = 10_000
    folders = spark.range(n).select(F.col("id").alias("folder_id"), F.when(F.col("id") > 0, F.col("id") - 1).alias("parent_id"))
    sizes = aggregates.folder_sizes(folders, spark.range(n).select(F.col("id").alias("folder_id"), F.lit(1).cast("bigint").alias("size")))
    assert sizes.filter(F.col("size") != n - F.col("folder_id")).count() == 0 and sizes.count() == n


def test_folders_in_each_other(spark):
    folders = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 4)], "folder_id int, parent_id int")
    with pytest.raises(ValueError, match="lie in each other"):
        aggregates.folder_sizes(folders, spark.createDataFrame([(1, 5)], "folder_id int, size bigint"))
