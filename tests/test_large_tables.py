"""What only tables of many files or many rows showed: tables stored as folders, and steps that grew too fast."""

from pyspark.sql import DataFrameWriter

from corvane import plans
from corvane.operators import postings, terms


def test_streams_read_a_table_of_several_files(spark, tmp_path):
    folder = str(tmp_path)
    spark.range(10).selectExpr("id AS doc_id", "'x' AS text").write.parquet(f"{folder}/documents.parquet")
    labels = spark.range(0, 10, 2).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic").repartition(3)
    labels.write.parquet(f"{folder}/labels.parquet")
    assert sorted(r.doc_id for r in plans.load()[0]["st6_prune_stream"](spark, folder).collect()) == [1, 3, 5, 7, 9]


def test_an_index_is_built_without_a_shuffle(spark, monkeypatch):
    chunks = spark.range(300).selectExpr("id AS chunk_id", "array('the', concat('w', id % 7)) AS body").coalesce(2)
    frames, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, **more: (frames.append(self._df), write(self, path, **more))[1])
    store = postings.build(chunks, {"body": "body"}, block_rows=64)
    plans_ = [f._jdf.queryExecution().executedPlan().toString() for f in frames if "ids" in f.columns]
    assert len(plans_) == 1 and "Exchange" not in plans_[0].replace("REPARTITION", "") and "Sort" not in plans_[0]
    assert store.blocks.count() == 6 and {r.term: r.df for r in store.stats.collect()}["the"] == 300


def test_counts_move_no_index_rows(spark, monkeypatch):
    """Every question meets every block, and only its counts are shuffled, whatever the tile; odd rows are none."""
    chunks = spark.range(200).selectExpr("id AS chunk_id", "array('the', concat('w', id % 7)) AS body", "IF(id % 3 = 0, array('a', 'b', 'b'), array()) AS tags")
    store = postings.build(chunks, {"body": "body"}, carry=["tags"], block_rows=16)
    needs = spark.range(50).selectExpr("id AS k", "explode(array('the', concat('w', id % 7), 'nowhere')) AS term", "CAST(id % 3 AS int) AS need")
    want = {}
    for q in range(50):
        for i in range(0, 200, 3):
            if q % 3 < 2 or q % 7 == i % 7:
                for tag in "abb":
                    want[q, tag] = want.get((q, tag), 0) + 1
    monkeypatch.setattr(postings, "_met", None)
    monkeypatch.setattr(postings, "PAIRS", 100)
    for rows in (7, 1000):
        assert {(r.k, r.value): r.n for r in postings.matched_counts(needs, store, "tags", "k", rows).collect()} == want
    assert postings.matched_counts(needs.filter("term = 'nowhere'"), store, "tags", "k").count() == 0
    assert postings.matched_counts(needs.limit(0), store, "tags", "k").count() == 0


def test_paragraph_queries_shuffle_their_terms_once(spark):
    texts = spark.createDataFrame([(1, [f"w{i}" for i in range(40)]), (2, ["w1", "x", "x"]), (3, []), (4, None)], "doc_id int, tokens array<string>")
    stats = spark.createDataFrame([(f"w{i}", i + 1, 20 * (i + 1)) for i in range(40)], "token string, df bigint, tf bigint")
    top = terms.paragraph_query(texts, stats, "doc_id", 30)
    rows = top.collect()
    assert sorted((r.doc_id, r.need) for r in rows) == [(1, 3)] * 30 + [(2, 0)] * 2
    assert {r.term for r in rows if r.doc_id == 1} == {f"w{i}" for i in range(30)}
    plan = top._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1 and plan.count("Aggregate") == 0


def test_the_stored_graph_takes_its_increments_from_files_of_many_tasks(spark, tmp_path, monkeypatch):
    from corvane.plans import long_queries

    rows = spark.range(0, 600, 1, 6).selectExpr("concat('b', id % 5) AS src", "concat('n', id % 3) AS dst", "1.0 AS weight", "substr('ANR', CAST(id % 3 AS int) + 1, 1) AS description", "'k' AS keywords", "'s' AS source_id")
    monkeypatch.setattr(long_queries, "trade_mentions", lambda s, f: rows)
    steps, apply = [], long_queries.graph_state.GraphStore.apply
    monkeypatch.setattr(long_queries.graph_state.GraphStore, "apply", lambda self, m, n: (steps.append(len(m.inputFiles())), apply(self, m, n))[1])
    edges = long_queries.followed_graph(spark, str(tmp_path), float("inf")).edges()
    assert len(steps) == 2 and sum(r.mentions for r in edges.collect()) == 600
