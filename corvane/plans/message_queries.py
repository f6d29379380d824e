"""Joins and running budgets over documents, hits and messages (J, W, and the memory half of M)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corvane.functions import text as tx
from corvane.operators import aggregates, joins, memory, ordering, retrieval
from corvane.plans import inputs as inp
from corvane.plans.registry import query, table
from corvane.plans.retrieval_queries import TEXT_HITS_SQL, top_text_hits
from corvane.session import cut_lineage

TOP_SQL = TEXT_HITS_SQL + """,
top AS (SELECT query_id, chunk_id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, chunk_id) AS rank
  FROM hits QUALIFY rank <= 30),
full_top AS (SELECT top.*, c.doc_id, c.ord, c.content, c.lang, c.source FROM top JOIN chunks c USING (chunk_id))"""


def full_top(spark, folder):
    top = top_text_hits(spark, folder, 30).withColumn("score", F.round("score", 6))
    return top.join(inp.chunks(spark, folder), "chunk_id")


@query(
    "j3_children_to_parents",
    f"""{TOP_SQL},
j AS (SELECT t.*, l.doc_id IS NOT NULL AS known FROM full_top t LEFT JOIN labels l USING (doc_id))
SELECT query_id, 'p' || doc_id AS hit_id, round(avg(score), 6) AS score, count(*) AS children,
  array_to_string(flatten(list({inp.sql_words('content')} ORDER BY -score, chunk_id)), ' ') AS tokens, string_agg(lang, ' ' ORDER BY -score, chunk_id) AS important
FROM j WHERE known GROUP BY query_id, doc_id
UNION ALL SELECT query_id, chunk_id, score, 0, array_to_string({inp.sql_words('content')}, ' '), lang FROM j WHERE NOT known
""",
)
def j3_children_to_parents(spark, folder):
    hits = full_top(spark, folder).select(
        "query_id",
        "chunk_id",
        F.concat(F.lit("p"), "doc_id").alias("parent_id"),
        "score",
        tx.words("content").alias("tokens"),
        F.array("lang").alias("important"),
    )
    parents = table(spark, folder, "labels").join(table(spark, folder, "documents"), "doc_id").select(
        F.concat(F.lit("p"), "doc_id").alias("parent_id"), F.col("text").alias("content")
    )
    return joins.children_to_parents(hits, parents).withColumns(
        {"tokens": F.array_join("tokens", " "), "important": F.array_join("important", " ")}
    )


@query(
    "j4_boost_by_toc",
    f"""{TOP_SQL},
best AS (SELECT query_id, arg_max(doc_id, (s, -doc_id)) AS doc_id FROM (SELECT query_id, doc_id, round(sum(score), 6) AS s FROM full_top GROUP BY ALL) GROUP BY query_id),
votes AS (SELECT item_id AS query_id, doc_id, chunk_id, (item_id + ord) % 6 AS vote FROM chunks CROSS JOIN (SELECT item_id FROM benchmark) q SEMI JOIN best b ON b.query_id = q.item_id AND b.doc_id = chunks.doc_id),
ts AS (SELECT query_id, doc_id, chunk_id, round(avg(vote / 5.0), 6) AS toc_score FROM votes WHERE vote >= 1 GROUP BY ALL HAVING round(avg(vote / 5.0), 6) >= 0.3),
u AS (SELECT query_id, doc_id, chunk_id, round(coalesce(t.score, 0) + coalesce(ts.toc_score, 0), 6) AS score FROM full_top t FULL JOIN ts USING (query_id, doc_id, chunk_id))
SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM u QUALIFY rank <= 6
""",
)
def j4_boost_by_toc(spark, folder):
    hits = cut_lineage(full_top(spark, folder).select("query_id", "doc_id", "chunk_id", "score"))
    pairs = hits.select("query_id", "doc_id").distinct()
    votes = pairs.join(inp.chunks(spark, folder).select("doc_id", "chunk_id", "ord"), "doc_id").withColumn(
        "vote", (F.col("query_id") + F.col("ord")) % 6
    )
    return joins.boost_by_toc(hits, joins.toc_scores(votes), 6)


@query(
    "j5_merge_research_hits",
    f"""{TOP_SQL}
SELECT query_id, chunk_id, score, 'first' AS round FROM top WHERE rank <= 10
UNION ALL SELECT query_id, chunk_id, score + 1, 'second' FROM top WHERE rank > 10
""",
)
def j5_merge_research_hits(spark, folder):
    top = cut_lineage(top_text_hits(spark, folder, 30).withColumn("score", F.round("score", 6)))
    first = top.filter("rank <= 10").select("query_id", "chunk_id", "score", F.lit("first").alias("round"))
    second = top.select("query_id", "chunk_id", (F.col("score") + 1).alias("score"), F.lit("second").alias("round"))
    return joins.merge_research_hits(first, second)


@query(
    "j6_enrich_with_metadata",
    f"""{TOP_SQL}
SELECT query_id, chunk_id, CASE WHEN quality IS NULL THEN 'tag=' || least(lang, source) || ', ' || greatest(lang, source)
  ELSE 'quality=' || quality || '; tag=' || least(lang, source) || ', ' || greatest(lang, source) END AS metadata
FROM full_top LEFT JOIN labels USING (doc_id)
""",
)
def j6_enrich_with_metadata(spark, folder):
    hits = full_top(spark, folder).select("query_id", "chunk_id", "doc_id")
    enriched = joins.enrich_with_metadata(hits, inp.metadata(spark, folder), ["tag", "quality"])
    shown = F.array_join(
        F.transform(F.array_sort(F.map_entries("metadata")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "; "
    )
    return enriched.select("query_id", "chunk_id", shown.alias("metadata"))


@query(
    "j7_doc_list_join",
    """
SELECT o_orderkey AS doc_id, CAST(l_linenumber AS BIGINT) AS link, p_name AS file_name, n_name AS flow, c_name AS creator
FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
  LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON n_nationkey = o_custkey % 25
  LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON c_custkey = o_custkey
""",
)
def j7_doc_list_join(spark, folder):
    documents = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("doc_id"), (F.col("o_custkey") % 25).alias("flow_id"), F.col("o_custkey").alias("user_id")
    )
    links = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"), F.col("l_partkey").alias("file_id"), F.col("l_linenumber").alias("link")
    )
    files = table(spark, folder, "part").select(F.col("p_partkey").alias("file_id"), F.col("p_name").alias("file_name"))
    flows = table(spark, folder, "nation").filter("n_regionkey < 3").select(
        F.col("n_nationkey").cast("bigint").alias("flow_id"), F.col("n_name").alias("flow")
    )
    users = table(spark, folder, "customer").filter("c_acctbal > 0").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("creator")
    )
    return joins.doc_list_join(documents, links, files, flows, users).select("doc_id", "link", "file_name", "flow", "creator")


@query(
    "j8_raw_with_extracts",
    f"""
WITH {inp.MESSAGES_SQL}
SELECT u.message_id, coalesce(string_agg(a.message_id, ',' ORDER BY a.message_id), '') AS extracts
FROM messages u LEFT JOIN messages a ON a.role = 'assistant' AND a.memory_id = u.memory_id AND a.turn = u.turn + 1 WHERE u.role = 'user' GROUP BY u.message_id
""",
)
def j8_raw_with_extracts(spark, folder):
    messages = inp.messages(spark, folder)
    raw = messages.filter("role = 'user'").select("message_id")
    extracts = messages.filter("role = 'assistant'").select(
        "message_id", F.concat_ws(":", "memory_id", (F.col("turn") - 1).cast("string")).alias("source_id")
    )
    return joins.raw_with_extracts(raw, extracts).withColumn("extracts", F.array_join("extracts", ","))


@query(
    "j15_metadata_facets",
    """
SELECT 'quality' AS key, CAST(quality AS VARCHAR) AS value, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY ALL
UNION ALL SELECT 'toxic', CAST(toxic AS VARCHAR), count(*) FROM documents JOIN labels USING (doc_id) GROUP BY ALL
UNION ALL SELECT NULL, NULL, count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""",
)
def j15_metadata_facets(spark, folder):
    meta = inp.metadata(spark, folder).filter(F.col("key").isin("quality", "toxic"))
    return joins.metadata_facets(table(spark, folder, "documents"), meta)


@query(
    "w2_fit_context",
    f"""{TOP_SQL},
t AS (SELECT query_id, chunk_id, rank, {inp.sql_token_count('content')} AS tokens FROM full_top)
SELECT query_id, chunk_id, rank FROM (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY query_id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM t WHERE tokens > 0) WHERE before <= 500 * 0.97
""",
)
def w2_fit_context(spark, folder):
    hits = full_top(spark, folder).withColumn("tokens", tx.token_count("content"))
    return ordering.fit_context(hits, 500).select("query_id", "chunk_id", "rank")


@query(
    "r17_format_context",
    f"""{TOP_SQL}
SELECT query_id, rank, md5(chr(10) || 'ID: ' || (rank - 1) || chr(10) || '├── Title: ' || source || chr(10) || '├── lang: ' || lang || chr(10) || '└── Content:' || chr(10) || content) AS block FROM full_top
""",
)
def r17_format_context(spark, folder):
    hits = full_top(spark, folder).withColumns(
        {"doc_name": F.col("source"), "url": F.lit(""), "metadata": F.create_map(F.lit("lang"), F.col("lang"))}
    )
    return retrieval.format_context(hits).select("query_id", "rank", F.md5("block").alias("block"))


@query(
    "w3_fit_memory",
    f"""
WITH t AS (SELECT conv_id AS memory_id, turn, sum({inp.sql_token_count('text')}) OVER (PARTITION BY conv_id ORDER BY turn) AS upto FROM conversations)
SELECT memory_id, turn FROM t WHERE upto <= 200 * 0.97
""",
)
def w3_fit_memory(spark, folder):
    messages = inp.messages(spark, folder).withColumn("tokens", tx.token_count("content"))
    return ordering.fit_memory(messages, 200).select("memory_id", "turn")


@query(
    "w4_fifo_evict",
    f"""
WITH {inp.MESSAGES_SQL},
s AS (SELECT *, octet_length(encode(content)) AS size, CASE WHEN forget_at IS NULL THEN 1 ELSE 0 END AS c, coalesce(forget_at, valid_at) AS t FROM messages)
SELECT memory_id, message_id, CAST(before AS BIGINT) AS freed_before FROM (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY memory_id % 3 ORDER BY c, t, message_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM s) WHERE before < 5000
""".replace("SELECT memory_id, message_id, CAST", "SELECT memory_id % 3 AS memory_id, message_id, CAST"),
)
def w4_fifo_evict(spark, folder):
    messages = inp.messages(spark, folder).withColumns(
        {"memory_id": F.col("memory_id") % 3, "size": aggregates.message_size(F.col("content"))}
    )
    return ordering.fifo_evict(messages, 5000).select("memory_id", "message_id", "freed_before")


@query(
    "w8_section_ids",
    f"""
WITH {inp.LINES_SQL}, l AS (SELECT doc_id, ord, length(line) % 5 AS level FROM lines)
SELECT doc_id, CAST(ord AS BIGINT) AS ord, CAST(sum(CASE WHEN level <= 1 AND ord > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY ord) AS BIGINT) AS section FROM l
""",
)
def w8_section_ids(spark, folder):
    lines = inp.lines(spark, folder).select("doc_id", "ord", (F.length("line") % 5).alias("level"), F.lit(1).alias("target"))
    return ordering.section_ids(lines).select("doc_id", "ord", "section")


@query(
    "w11_recent_messages",
    f"WITH {inp.MESSAGES_SQL} SELECT memory_id, message_id, row_number() OVER (PARTITION BY memory_id ORDER BY valid_at DESC, message_id) AS rank FROM messages QUALIFY rank <= 3",
)
def w11_recent_messages(spark, folder):
    return ordering.recent_messages(inp.messages(spark, folder), 3).select("memory_id", "message_id", "rank")


@query(
    "m8_remember",
    f"""
WITH {inp.MESSAGES_SQL},
a AS (SELECT memory_id % 5 AS memory_id, message_id, 'raw' AS kind, content, valid_at, forget_at FROM messages
  UNION ALL SELECT memory_id % 5, message_id || ':fact', 'fact', {inp.sql_words('content')}[1], valid_at, NULL FROM messages WHERE role = 'user'),
s AS (SELECT *, octet_length(encode(content)) AS size FROM a),
tot AS (SELECT memory_id, sum(size) AS total FROM s GROUP BY memory_id),
b AS (SELECT s.*, total, coalesce(sum(size) OVER (PARTITION BY memory_id ORDER BY forget_at IS NULL, coalesce(forget_at, valid_at), message_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS freed FROM s JOIN tot USING (memory_id))
SELECT memory_id, message_id, kind, CAST(size AS BIGINT) AS size FROM b WHERE freed >= total - 20000
""",
)
def m8_remember(spark, folder):
    messages = inp.messages(spark, folder).withColumn("memory_id", F.col("memory_id") % 5)
    facts = messages.filter("role = 'user'").select(
        "memory_id",
        F.concat("message_id", F.lit(":fact")).alias("message_id"),
        F.element_at(tx.words("content"), 1).alias("content"),
        "valid_at",
    )
    return memory.remember(messages, facts, 20000).select("memory_id", "message_id", "kind", "size")


@query("m9_fill_missing", f"WITH {inp.MESSAGES_SQL} SELECT message_id FROM messages WHERE forget_at IS NULL")
def m9_fill_missing(spark, folder):
    return memory.fill_missing(inp.messages(spark, folder), "forget_at").select("message_id")


@query("m10_conversation_fit")
def m10_conversation_fit(spark, folder):
    rows = inp.messages(spark, folder).select("memory_id", "turn", "role", "content")
    return memory.conversation_fit(rows, 120)


@query(
    "w5_fit_graph_context",
    """
WITH e AS (SELECT n_regionkey AS query_id, n_name AS item, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) AS rank, n_nationkey + 10 AS tokens FROM nation),
r AS (SELECT c_nationkey % 5 AS query_id, c_name AS item, row_number() OVER (PARTITION BY c_nationkey % 5 ORDER BY c_name) AS rank, c_nationkey + 1 AS tokens FROM customer),
eu AS (SELECT *, sum(tokens) OVER (PARTITION BY query_id ORDER BY rank) AS upto FROM e),
used AS (SELECT query_id, max(upto) FILTER (WHERE upto < 150) AS kept, min(upto) FILTER (WHERE upto >= 150) AS over FROM eu GROUP BY query_id),
ru AS (SELECT *, sum(tokens) OVER (PARTITION BY query_id ORDER BY rank) AS upto FROM r)
SELECT CAST(query_id AS BIGINT) AS query_id, 'entity' AS kind, item FROM eu WHERE upto < 150
UNION ALL SELECT CAST(query_id AS BIGINT), 'relation', item FROM ru JOIN used USING (query_id) WHERE upto < 150 - coalesce(over, kept, 0)
""",
)
def w5_fit_graph_context(spark, folder):
    place = lambda key, name: F.row_number().over(Window.partitionBy(key).orderBy(name))
    nations = table(spark, folder, "nation")
    entities = nations.select(
        F.col("n_regionkey").alias("query_id"), place("n_regionkey", "n_name").alias("rank"), F.col("n_name").alias("item"), (F.col("n_nationkey") + 10).alias("tokens")
    )
    customers = table(spark, folder, "customer").withColumn("query_id", F.col("c_nationkey") % 5)
    relations = customers.select(
        "query_id", place("query_id", "c_name").alias("rank"), F.col("c_name").alias("item"), (F.col("c_nationkey") + 1).alias("tokens")
    )
    kept = ordering.fit_graph_context(entities, relations, 150)
    return kept.select("query_id", F.when(F.col("kind") == 0, "entity").otherwise("relation").alias("kind"), "item")
