"""Queries written as SQL text: table search (R13), the registered functions and the table function."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import sql as sql_functions
from corvane.functions import text as tx
from corvane.operators import table_search
from corvane.plans import inputs as inp
from corvane.plans.chunk_queries import CHUNK_DIGEST_SQL, documents, merged_sql, overlapped_sql
from corvane.plans.registry import query, table
from corvane.plans.retrieval_queries import centroids
from corvane.plans.term_sql import CENTROID_SQL, COUNTS_SQL, RAW_WEIGHT_SQL, STATS_SQL


def named_parts(spark, folder):
    """Parts as rows of a spreadsheet: a dataset, the words of the name, and the columns answers must name."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("doc_id"), F.concat_ws("/", "p_brand", "p_name").alias("doc_name"), F.col("p_brand").alias("dataset"),
        tx.words("p_name").alias("name_words"), "p_type", "p_size", "p_retailprice",
    )


@query(
    "r13_search_rows",
    r"""
SELECT p_partkey AS doc_id, p_brand || '/' || p_name AS doc_name, p_size, p_retailprice FROM part
WHERE p_brand <> 'Brand#10' AND (p_size > 40 OR p_size < 5)
  AND len(list_intersect(['red', 'widget', 'small', 'steel'], regexp_extract_all(lower(p_name), '[\p{L}\p{N}_]+'))) >= 1
""",
)
def r13_search_rows(spark, folder):
    """Row search: the OR of the text must not reach rows out of scope."""
    text = """```sql
SELECT doc_id, doc_name, p_size, p_retailprice FROM rows WHERE name_words = 'Red widget, small steel' AND p_size > 40 OR p_size < 5 AND name_words LIKE '%red widget small steel%';
```"""
    return table_search.table_search(
        named_parts(spark, folder), text, F.col("dataset") != "Brand#10", ["name_words"], ["doc_id", "doc_name"]
    )


@query(
    "r13_search_groups",
    r"""
SELECT p_type, count(*) AS n, round(max(p_retailprice), 6) AS dearest FROM part WHERE p_brand <> 'Brand#10'
  AND len(list_intersect(['widget', 'blue'], regexp_extract_all(lower(p_name), '[\p{L}\p{N}_]+'))) >= 1 GROUP BY p_type
""",
)
def r13_search_groups(spark, folder):
    text = "SELECT p_type, count(*) AS n, max(p_retailprice) AS dearest FROM rows WHERE name_words='widget blue' GROUP BY p_type"
    return table_search.table_search(
        named_parts(spark, folder), text, F.col("dataset") != "Brand#10", ["name_words"], ["doc_id", "doc_name"]
    )


@query(
    "r13_sql_token_match",
    f"""
WITH {inp.CHUNKS_SQL}, c AS (SELECT chunk_id, doc_id, {inp.sql_words('content')} AS w FROM chunks),
q AS (SELECT item_id, list_distinct({inp.sql_words('text')}) AS t FROM benchmark)
SELECT chunk_id, item_id AS query_id FROM c JOIN q ON item_id = doc_id % (SELECT count(*) FROM benchmark)
WHERE len(list_intersect(t, w)) >= greatest(1, floor(len(t) * 0.2))
""",
)
def r13_sql_token_match(spark, folder):
    """Every chunk against the question that its document number points to."""
    sql_functions.register(spark)
    return spark.sql(
        """SELECT chunk_id, query_id FROM {chunks} JOIN {asked} ON query_id = doc_id % (SELECT count(*) FROM {asked})
           WHERE token_match(tokens, text, 0.2D)""",
        chunks=inp.chunks(spark, folder).select("chunk_id", "doc_id", tx.words("content").alias("tokens")),
        asked=inp.questions(spark, folder),
    )


@query(
    "r13_sql_cosine",
    f"WITH {inp.CHUNKS_SQL}, {CENTROID_SQL} SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), vector), 6) AS cosine FROM embeddings JOIN cen USING (label)",
)
def r13_sql_cosine(spark, folder):
    """Every vector against the mean of its label; the batch form must agree."""
    sql_functions.register(spark)
    return spark.sql(
        """SELECT vec_id, cosine FROM (
             SELECT vec_id, cosine(embedding, vector) AS cosine, cosine_batch(CAST(embedding AS ARRAY<DOUBLE>), vector) AS batch
             FROM {v} JOIN {m} USING (label))
           WHERE abs(cosine - batch) < 1e-9""",
        v=table(spark, folder, "embeddings"),
        m=centroids(spark, folder),
    )


@query(
    "r13_sql_term_weight",
    f"WITH {STATS_SQL}, w AS (SELECT token, df, tf, {COUNTS_SQL} FROM stats) SELECT token, df, tf, round({RAW_WEIGHT_SQL}, 6) AS weight FROM w",
)
def r13_sql_term_weight(spark, folder):
    sql_functions.register(spark)
    return spark.sql(
        """WITH w AS (SELECT doc_id, words(text) AS w FROM {docs}), t AS (SELECT doc_id, explode(w) AS token FROM w),
             s AS (SELECT token, count(DISTINCT doc_id) AS df, count(*) AS tf FROM t GROUP BY token)
           SELECT token, df, tf, term_weight(token, tf, df) AS weight FROM s""",
        docs=documents(spark, folder),
    )


@query("c1_split_chunks_lateral", f"WITH RECURSIVE {merged_sql(128 * 0.8)}, {overlapped_sql(20)} {CHUNK_DIGEST_SQL} lapped")
def c1_split_chunks_lateral(spark, folder):
    """The table function on every document: chunks of 128 tokens with 20 percent overlap."""
    sql_functions.register(spark)
    return spark.sql(
        "SELECT doc_id, c.chunk, md5(c.content) AS content FROM {docs}, LATERAL split_chunks(text, 128, 20) c",
        docs=documents(spark, folder),
    )
