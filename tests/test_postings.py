"""The stored index: what it holds, exact top rows with skipped blocks, hot terms, carried columns, odd rows."""

import random
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from corvane.functions import text as tx
from corvane.operators import ordering, postings, terms


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    weights = [1 / (i + 1) for i in range(40)]
    rows = [(i, ["the", *rng.choices(words, weights, k=rng.randint(0, 12))], rng.choices(words, k=rng.randint(0, 3)), [f"t{i % 3}"] * (i % 4 > 0) + ["all"]) for i in range(300)]
    rows += [(300, None, None, []), (301, [], ["w1"], ["t1"])]
    df = spark.createDataFrame(rows, "chunk_id int, body array<string>, title array<string>, tags array<string>").repartition(3, "chunk_id")
    return rows, df, postings.build(df, {"body": "body", "title": "title"}, carry=["tags"], block_rows=16)


def asked(spark, seed, n=20, size=6):
    rng = random.Random(seed)
    return [(q, w, rng.random()) for q in range(n) for w in {"the", "nowhere", *rng.choices([f"w{i}" for i in range(45)], k=size)}]


def test_index_holds_all_counts(corpus):
    rows, _, store = corpus
    want = {(i, w): (Counter(body or [])[w], Counter(title or [])[w]) for i, body, title, _ in rows for w in {*(body or []), *(title or [])}}
    own = {r.block: r for r in store.rows.filter("lot = -1").collect()}
    got = {}
    for r in store.rows.filter("lot <> -1").collect():
        for at, b, t in zip(r.at, r.tf_body, r.tf_title):
            got[own[r.block].ids[at], r.term] = (b, t)
    assert got == want
    stats = {r.term: (r.df, r.tf, r.df_body, r.df_title) for r in store.stats.collect()}
    for w in ("the", "w1", "w39"):
        mine = [c for (_, x), c in want.items() if x == w]
        assert stats[w] == (len(mine), sum(map(sum, mine)), sum(b > 0 for b, _ in mine), sum(t > 0 for _, t in mine))


@pytest.mark.parametrize("topn", [1, 5, 1000])
def test_best_rows_are_exact(spark, corpus, topn):
    _, _, store = corpus
    df = spark.createDataFrame(asked(spark, 7), "query_id int, term string, weight double")
    boosts = {"body": 1.0, "title": 4.0}
    rank = lambda hits: sorted(map(tuple, ordering.topk_per_query(hits.drop("matched"), topn).collect()))
    full = postings.text_match(df, store, boosts, 0.2)
    some = postings.text_match(df, store, boosts, 0.2, topn, tile_rows=7, first_blocks=2)
    assert rank(full) == rank(some)
    if topn == 1:
        assert some.count() < full.count()


def test_blocks_out_of_reach_are_not_read(spark, monkeypatch):
    rare = [(i, ["common"] * 1 + [f"x{i}"] * 30 + (["rare"] if i < 3 else [])) for i in range(64)]
    df = spark.createDataFrame(rare, "chunk_id int, body array<string>").coalesce(1)
    store = postings.build(df, {"body": "body"}, block_rows=4)
    met = []
    real = postings._met
    monkeypatch.setattr(postings, "_met", lambda a, s, pairs, c: (met.append(pairs.count()), real(a, s, pairs, c))[1])
    hits = postings.text_match(spark.createDataFrame([(1, "common", 0.01), (1, "rare", 1.0)], "query_id int, term string, weight double"), store, {"body": 1.0}, 0.3, 2, first_blocks=1)
    assert {r.chunk_id for r in ordering.topk_per_query(hits, 2).collect()} <= {0, 1, 2} and met == [1, 0]


def test_a_term_in_every_chunk_makes_no_hot_task(spark, corpus):
    _, _, store = corpus
    df = spark.createDataFrame([(q, "the", 1.0) for q in range(40)], "query_id int, term string, weight double")
    terms_ = postings._asked(df, store, F.lit(1).cast("bigint"), 8).withColumns({"w_body": F.lit(1.0), "w_title": F.lit(1.0)})
    left, right = postings._met(terms_, store, None, ["query_id", "term", "need"])
    groups = [r["count"] for r in right.groupBy("of_tile", "of_block").count().collect()]
    assert max(groups) <= 20 and len(groups) > 60 and max(r["count"] for r in left.groupBy("tile", "block").count().collect()) == 2
    assert postings.text_match(df, store, {"body": 1.0, "title": 1.0}, 0.3).count() == 40 * 300


def test_carried_values_are_counted(spark, corpus):
    rows, _, store = corpus
    needs = [(q, w, need) for q, need in ((1, 0), (2, 1), (3, 2), (4, 3)) for w in ("the", "w1", "w2", "w7")]
    df = spark.createDataFrame(needs, "k int, term string, need int")
    got = {(r.k, r.value): r.n for r in postings.matched_counts(df, store, "tags", "k", tile_rows=2).collect()}
    want = Counter()
    for q, need in ((1, 0), (2, 1), (3, 2), (4, 3)):
        for _, body, title, tags in rows:
            if len({"the", "w1", "w2", "w7"} & {*(body or []), *(title or [])}) >= max(1, need):
                want.update((q, t) for t in tags)
    assert got == want


def test_no_chunks_and_no_questions(spark, corpus):
    _, df, store = corpus
    none = spark.createDataFrame([], "query_id int, term string, weight double")
    empty = postings.build(df.limit(0), {"body": "body", "title": "title"}, carry=["tags"])
    some = spark.createDataFrame([(1, "the", 1.0)], "query_id int, term string, weight double")
    assert postings.text_match(none, store, {"body": 1.0, "title": 1.0}).count() == 0
    assert postings.text_match(some, empty, {"body": 1.0, "title": 1.0}).count() == 0


def test_counted_tokens(spark):
    rows = [(1, ["b", "a", "b"]), (2, []), (3, None), (4, ["x"]), (5, [str(i % 7) for i in range(50_000)])]
    df = spark.createDataFrame(rows, "doc_id int, tokens array<string>")
    got = {r.doc_id: {e.token: e.n for e in r.c} for r in df.select("doc_id", tx.counted("tokens").alias("c")).collect()}
    assert got == {i: dict(Counter(t or [])) for i, t in rows}
    stats = {r.token: (r.df, r.tf) for r in terms.document_frequency(df, "doc_id").collect()}
    assert stats["b"] == (1, 2) and stats["x"] == (1, 1) and stats["0"] == (1, 7143)


def test_few_blocks_are_read_at_once(spark, tmp_path):
    """Spark reads a row group of a file in one go, so the memory of a task that reads the index must not follow its files."""
    rows = [(i, [f"w{i % 7}", f"w{i % 5}"]) for i in range(90)]
    chunks = spark.createDataFrame(rows, "chunk_id int, body array<string>").coalesce(1)
    store = postings.build(chunks, {"body": "body"}, folder=f"{tmp_path}/index", block_rows=10)
    files = [pq.ParquetFile(f).metadata for f in (tmp_path / "index").glob("*.parquet")]
    groups = [m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)]
    assert sum(groups) == store.blocks.count() == 9 and max(groups) <= 2
