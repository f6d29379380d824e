"""The steps that the text queries share: questions sent to the blocks, titles, few rows joined with many."""

import random

from pyspark.sql import functions as F

from corvane.operators import postings, retrieval
from corvane.plans import retrieval_queries, text_queries


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def sample(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    rows = [(i, rng.choices(words, k=rng.randint(0, 9)), rng.choices(words, k=2)) for i in range(200)]
    df = spark.createDataFrame(rows, "chunk_id int, body array<string>, title array<string>").repartition(3, "chunk_id")
    asked = [(f"q{q}", w, rng.random()) for q in range(23) for w in {*rng.choices(words, k=5), "nowhere"}]
    return postings.build(df, {"body": "body", "title": "title"}, block_rows=16), spark.createDataFrame(asked, "query_id string, term string, weight double")


def test_few_questions_move_no_index_rows(spark, monkeypatch):
    store, asked = sample(spark)
    boosts = {"body": 1.0, "title": 3.0}
    rows = lambda topn: sorted(map(tuple, postings.text_match(asked, store, boosts, 0.3, topn, tile_rows=7, skip_blocks=False).collect()))
    sent = [rows(None), rows(2)]
    assert "CoGroup" not in plan_of(postings.text_match(asked, store, boosts, 0.3))
    monkeypatch.setattr(postings, "SENT", 10)
    assert "CoGroup" in plan_of(postings.text_match(asked, store, boosts, 0.3))
    assert [rows(None), rows(2)] == sent and len(sent[1]) < len(sent[0])


def test_more_questions_are_sent_in_lots(spark, monkeypatch):
    store, asked = sample(spark)
    boosts = {"body": 1.0, "title": 3.0}
    rows = lambda topn: sorted(map(tuple, postings.text_match(asked, store, boosts, 0.3, topn, tile_rows=7, skip_blocks=False).collect()))
    whole = [rows(None), rows(2)]
    monkeypatch.setattr(postings, "SENT", 30)
    sent = []
    real = postings._scored_in_place
    monkeypatch.setattr(postings, "_scored_in_place", lambda asked, *rest: sent.append(asked.count()) or real(asked, *rest))
    assert "CoGroup" not in plan_of(postings.text_match(asked, store, boosts, 0.3))
    assert len(sent) > 2 and max(sent) < sum(sent)
    assert [rows(None), rows(2)] == whole and len(whole[0]) > 100


def test_best_of_all_blocks_without_marks(spark, monkeypatch):
    store, asked = sample(spark)
    monkeypatch.setattr(postings, "_met", lambda *_: 1 / 0)
    assert postings.text_match(asked, store, {"body": 1.0, "title": 3.0}, 0.3, 5, skip_blocks=False).count() > 0


def test_a_line_does_not_carry_its_whole_text(spark, tmp_path, monkeypatch):
    rows = [(1, "First Line\nsecond line\n\n third", "s"), (2, None, "s"), (3, "one", None), (4, "\nbody", "t")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    made = []
    monkeypatch.setattr(text_queries, "cut_lineage", lambda df: made.append(df) or df)
    got = {(r.doc_id, *r.title_tokens, "|", *r.tokens) for r in text_queries.indexed_chunks(spark, str(tmp_path)).collect()}
    assert got == {(1, "first", "line", "|", "first", "line"), (1, "first", "line", "|", "second", "line"), (1, "first", "line", "|", "third"), (3, "one", "|", "one"), (4, "|", "body")}
    above, below = plan_of(made[0]).split("Generate", 1)
    assert "text#" not in above and "text#" not in below.splitlines()[0]


def test_pairs_meet_the_chunks_before_their_questions(spark):
    pairs = spark.createDataFrame([(1, 7), (2, 8), (3, 7), (1, 9)], "query_id int, chunk_id int")
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 2.0])], "query_id int, vector array<double>")
    vectors = spark.createDataFrame([(7, [3.0, 4.0]), (8, [0.0, 1.0])], "chunk_id int, embedding array<float>")
    found = retrieval.pair_similarity(pairs, queries, vectors)
    assert {(r.query_id, r.chunk_id, round(r.cosine, 6)) for r in found.collect()} == {(1, 7, 0.6), (2, 8, 1.0), (3, 7, 0.0), (1, 9, 0.0)}
    joins = [line for line in plan_of(found).splitlines() if "Join LeftOuter" in line]
    assert "query_id" in joins[0] and "chunk_id" in joins[1]


def test_candidates_are_written_before_they_meet_all_chunks(spark, monkeypatch):
    seen = []
    real = retrieval.cut_lineage
    monkeypatch.setattr(retrieval, "cut_lineage", lambda df: seen.append(df.columns) or real(df))
    first = spark.createDataFrame([(1, i, 0.5, 0.5, i) for i in range(1, 100)], "query_id int, chunk_id int, score double, cosine double, rank int")
    chunks = spark.range(1, 200).select(F.col("id").cast("int").alias("chunk_id"), F.col("id").alias("doc_id"), F.lit("n").alias("doc_name"), F.array(F.lit("a")).alias("tokens"), F.array(F.lit("b")).alias("title_tokens"))
    features = spark.createDataFrame([(1, {"a": 1.0}, 1.0)], "query_id int, features map<string,double>, feature_total double")
    rows, facets = retrieval.retrieval(first, chunks, chunks.select("doc_id"), features)
    assert rows.count() == 10 and facets.agg(F.sum("n")).first()[0] == 70
    assert seen == [["query_id", "chunk_id", "cosine"], ["chunk_id", "query_id", "cosine"]]


def test_top_hits_are_written(spark, monkeypatch):
    hits = spark.createDataFrame([(q, c, float(c)) for q in range(3) for c in range(9)], "query_id int, chunk_id int, score double")
    monkeypatch.setattr(retrieval_queries, "text_hits", lambda *_: hits)
    top = retrieval_queries.top_text_hits(spark, "", 4)
    assert top.count() == 12 and "Window" not in plan_of(top)
