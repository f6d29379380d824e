"""SQL functions, the table function and table search."""

import pytest
from pyspark.sql import functions as F

from corvane.functions import scalars, sql
from corvane.functions import text as tx
from corvane.operators import chunking, retrieval, table_search, terms


def test_functions_agree_with_columns(spark):
    sql.register(spark)
    rows = spark.createDataFrame(
        [("Red, small widget", ["red", "x"], [1.0, 2.0], [2.0, -1.0], 5, 2), ("", ["a"], [0.0], [1.0], None, None), ("12 345", [], [1.0], [1.0, 2.0], 0, 1)],
        "text string, tokens array<string>, a array<double>, b array<double>, tf bigint, df bigint",
    )
    for r in rows.select(
        F.expr("words(text)").alias("w1"), tx.words("text").alias("w2"),
        F.expr("token_match(tokens, text)").alias("m1"), retrieval.token_match(F.col("tokens"), F.col("text")).alias("m2"),
        F.expr("cosine(a, b)").alias("c1"), scalars.cosine(F.col("a"), F.col("b")).alias("c2"), F.expr("cosine_batch(a, b)").alias("c3"),
        *[f(t, i) for i, t in enumerate(("abc", "ab", "12", "über", "9x")) for f in (
            lambda t, i: F.expr(f"term_weight('{t}', tf, df)").alias(f"t{i}"),
            lambda t, i: terms.raw_term_weight(F.lit(t), F.col("tf"), F.col("df")).alias(f"u{i}"),
        )],
    ).collect():
        assert r.w1 == r.w2 and r.m1 == r.m2 and r.c1 == pytest.approx(r.c2) and r.c1 == pytest.approx(r.c3)
        assert all(r[f"t{i}"] == pytest.approx(r[f"u{i}"]) for i in range(5))


@pytest.mark.parametrize("overlap", [0, 25])
def test_split_chunks_is_chunk_by_tokens(spark, overlap):
    sql.register(spark)
    docs = spark.createDataFrame([(1, "a b\nc d e\n\nf 漢字 — x y\ng"), (2, ""), (3, "one"), (4, "\n\n"), (5, None)], "doc_id int, text string")
    lateral = spark.sql(f"SELECT doc_id, c.chunk, c.content FROM {{d}}, LATERAL split_chunks(text, 3, {overlap}) c", d=docs)
    want = chunking.chunk_by_tokens(docs.filter("text is not null"), 3, overlap).select("doc_id", "chunk", "content")
    assert sorted(map(tuple, lateral.collect())) == sorted(map(tuple, want.collect()))


def test_table_search(spark):
    rows = spark.createDataFrame(
        [(1, "a", "x", ["red", "fox"], "rows"), (2, "b", "x", ["blue"], "it's"), (3, "c", "y", ["red"], "rows")],
        "doc_id int, doc_name string, dataset string, words array<string>, note string",
    )
    ask = lambda text, **more: table_search.table_search(rows, text, F.col("dataset") == "x", ["words"], ["doc_id", "doc_name"], **more)
    ids = lambda df: sorted(r.doc_id for r in df.collect())
    assert ids(ask("SELECT doc_id, doc_name FROM rows WHERE words = 'Red fox' OR 1 = 1;")) == [1, 2]
    assert ids(ask("```sql\nselect rows.* from rows where rows.words like '%red%'\n```")) == [1]
    assert ids(ask("SELECT doc_id, doc_name FROM rows WHERE note = 'rows'")) == [1]
    assert ids(ask("SELECT doc_id, doc_name FROM rows WHERE note = 'it''s' AND words = 'blue'")) == [2]
    assert ask("SELECT count(*) AS n FROM rows").first().n == 2
    with pytest.raises(ValueError, match="doc_name"):
        ask("SELECT doc_id FROM rows")
