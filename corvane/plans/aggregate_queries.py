"""Facets, summaries, merges and statistics over the given tables (A ids)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import text as tx
from corvane.operators import aggregates
from corvane.plans import inputs as inp
from corvane.plans.registry import query, table


@query(
    "a1_terms_count",
    """
SELECT 'scalar' AS name, lang AS value, count(*) AS n FROM documents GROUP BY ALL
UNION ALL SELECT 'array', value, count(*) FROM (SELECT unnest([lang, source]) AS value FROM documents) GROUP BY ALL
""",
)
def a1_terms_count(spark, folder):
    docs = table(spark, folder, "documents").withColumn("tags", F.array("lang", "source", F.lit(" ")))
    named = lambda name, df: df.select(F.lit(name).alias("name"), "value", "n")
    return named("scalar", aggregates.terms_count(docs, "lang")).unionByName(
        named("array", aggregates.terms_count(docs, "tags"))
    )


@query(
    "a3_tag_portions",
    "SELECT source AS tag, count(*) AS n, round((count(*) + 1) / (sum(count(*)) OVER () + 1000), 6) AS portion FROM documents GROUP BY source",
)
def a3_tag_portions(spark, folder):
    return aggregates.tag_portions(table(spark, folder, "documents").select(F.col("source").alias("tag")))


@query(
    "a4_merge_tag_counts",
    """
SELECT tag, count(*) AS n FROM (SELECT source AS tag FROM documents UNION ALL SELECT lang FROM documents UNION ALL SELECT 'en' FROM conversations WHERE role = 'user') GROUP BY tag
""",
)
def a4_merge_tag_counts(spark, folder):
    docs = table(spark, folder, "documents")
    count = lambda df, c: df.groupBy(F.col(c).alias("tag")).agg(F.count(F.lit(1)).alias("n"))
    users = table(spark, folder, "conversations").filter("role = 'user'").select(F.lit("en").alias("tag"))
    return aggregates.merge_tag_counts([count(docs, "source"), count(docs, "lang"), count(users, "tag")])


@query(
    "a5_metadata_summary",
    f"""
WITH {inp.META_SQL},
d AS (SELECT doc_id, key, CASE WHEN count(*) > 1 THEN 'list' WHEN regexp_matches(max(value), '^-?\\d+(\\.\\d+)?$') THEN 'number' ELSE 'string' END AS type FROM meta GROUP BY doc_id, key),
t AS (SELECT key, arg_min(type, (-n, type)) AS type FROM (SELECT key, type, count(*) AS n FROM d GROUP BY key, type) GROUP BY key)
SELECT key, value, count(*) AS n, type FROM meta JOIN t USING (key) GROUP BY ALL
""",
)
def a5_metadata_summary(spark, folder):
    return aggregates.metadata_summary(inp.metadata(spark, folder)).select("key", "value", "n", "type")


@query(
    "a6_flatten_metadata",
    f"""
WITH {inp.META_SQL},
p AS (SELECT DISTINCT key, value, doc_id FROM meta)
SELECT key, value, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS doc_ids, count(*) AS n FROM p GROUP BY key, value
""",
)
def a6_flatten_metadata(spark, folder):
    return aggregates.flatten_metadata(inp.metadata(spark, folder)).withColumn(
        "doc_ids", F.array_join(F.col("doc_ids").cast("array<string>"), ",")
    )


def document_rows(spark, folder):
    """Documents as catalogue rows: the language is the suffix, the label quality the run state."""
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return table(spark, folder, "documents").join(labels, "doc_id", "left").select(
        "doc_id",
        F.col("source").alias("dataset_id"),
        F.col("lang").alias("suffix"),
        F.coalesce(F.col("quality").cast("string"), F.lit("unstart")).alias("run"),
        F.col("n_chars").alias("size"),
        F.size(F.split("text", "\n")).cast("bigint").alias("chunk_num"),
        tx.token_count("text").alias("token_num"),
    )


@query(
    "a7_doc_facets",
    """
SELECT 'suffix' AS facet, lang AS value, count(*) AS n FROM documents GROUP BY lang
UNION ALL SELECT 'run', coalesce(CAST(quality AS VARCHAR), 'unstart'), count(*) FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL
UNION ALL SELECT 'metadata.toxic', CAST(toxic AS VARCHAR), count(*) FROM labels WHERE doc_id IN (SELECT doc_id FROM documents) GROUP BY toxic
UNION ALL SELECT 'metadata.quality', CAST(quality AS VARCHAR), count(*) FROM labels WHERE doc_id IN (SELECT doc_id FROM documents) GROUP BY quality
UNION ALL SELECT 'empty_metadata', 'true', count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""",
)
def a7_doc_facets(spark, folder):
    meta = inp.metadata(spark, folder).filter(F.col("key").isin("toxic", "quality"))
    return aggregates.doc_facets(document_rows(spark, folder), meta)


@query(
    "a8_parsing_status",
    """
SELECT source AS dataset_id, count(*) FILTER (WHERE quality IS NULL) AS unstart, count(*) FILTER (WHERE quality = 0) AS "0", count(*) FILTER (WHERE quality = 1) AS "1", count(*) FILTER (WHERE quality = 9) AS "9"
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source
""",
)
def a8_parsing_status(spark, folder):
    return aggregates.parsing_status(document_rows(spark, folder), ["unstart", "0", "1", "9"])


USAGE_SQL = """
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS pv, count(DISTINCT user_id) AS uv,
  round(sum(k) / (sum(value) + 0.1), 6) AS speed, sum(k) / 1000.0 AS tokens, round(avg(event_id % 7), 6) AS rounds,
  CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS thumb_up
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events) GROUP BY 1
"""


def conversation_rows(events):
    """Events as conversation statistics rows."""
    return events.select(
        F.col("ts").alias("created_at"),
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("tokens"),
        F.col("value").alias("duration"),
        (F.col("event_id") % 7).alias("rounds"),
        (F.col("event_type") == "click").cast("bigint").alias("thumb_up"),
    )


@query("a9_usage_stats", USAGE_SQL)
def a9_usage_stats(spark, folder):
    stats = aggregates.usage_stats(conversation_rows(table(spark, folder, "events")))
    return stats.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(
    "a10_dataset_totals",
    f"""
SELECT source AS dataset_id, count(*) AS documents, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS chunks,
  CAST(sum({inp.sql_token_count('text')}) AS BIGINT) AS tokens, CAST(sum(n_chars) AS BIGINT) AS size
FROM documents GROUP BY source
""",
)
def a10_dataset_totals(spark, folder):
    return aggregates.dataset_totals(document_rows(spark, folder))


@query(
    "a11_folder_sizes",
    """
WITH f AS (SELECT 'n' || n_nationkey AS folder_id, count(*) AS files, CAST(sum(length(c_name)) AS BIGINT) AS size, n_regionkey
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)
SELECT folder_id, size FROM f
UNION ALL SELECT 'r' || r_regionkey, CAST(coalesce(sum(size), 0) AS BIGINT) FROM region LEFT JOIN f ON n_regionkey = r_regionkey GROUP BY r_regionkey
UNION ALL SELECT 'root', CAST(sum(size) AS BIGINT) FROM f
UNION ALL SELECT 'n' || n_nationkey, 0 FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer)
""",
)
def a11_folder_sizes(spark, folder):
    regions = table(spark, folder, "region").select(
        F.concat(F.lit("r"), "r_regionkey").alias("folder_id"), F.lit("root").alias("parent_id")
    )
    nations = table(spark, folder, "nation").select(
        F.concat(F.lit("n"), "n_nationkey").alias("folder_id"), F.concat(F.lit("r"), "n_regionkey").alias("parent_id")
    )
    root = regions.select(F.lit("root").alias("folder_id"), F.lit("root").alias("parent_id")).distinct()
    files = table(spark, folder, "customer").select(
        F.concat(F.lit("n"), "c_nationkey").alias("folder_id"), F.length("c_name").cast("bigint").alias("size")
    )
    return aggregates.folder_sizes(regions.unionByName(nations).unionByName(root), files)


@query("a12_memory_size", "SELECT conv_id AS memory_id, CAST(sum(octet_length(encode(text))) AS BIGINT) AS size FROM conversations GROUP BY conv_id")
def a12_memory_size(spark, folder):
    return aggregates.memory_size(inp.messages(spark, folder))


@query(
    "a13_combine_records",
    """
WITH v AS (SELECT conv_id, turn, 'role' AS key, [role] AS vs FROM conversations UNION ALL SELECT conv_id, turn, 'turn', [CAST(turn AS VARCHAR), 'x'] FROM conversations)
SELECT conv_id, key, array_to_string(flatten(list(vs ORDER BY turn)), ',') AS vals, len(flatten(list(vs))) = 1 AS scalar FROM v GROUP BY conv_id, key
""",
)
def a13_combine_records(spark, folder):
    records = table(spark, folder, "conversations").select(
        "conv_id",
        "turn",
        F.create_map(F.lit("role"), F.array("role"), F.lit("turn"), F.array(F.col("turn").cast("string"), F.lit("x"))).alias("record"),
    )
    return aggregates.combine_records(records, "conv_id", "turn").select(
        "conv_id", "key", F.array_join("values", ",").alias("vals"), "scalar"
    )


MENTIONS_SQL = """mentions AS (
  SELECT upper(p_name) AS name, p_type AS type, p_brand AS description, CAST(p_size AS VARCHAR) AS source_id FROM part)"""


def part_mentions(spark, folder):
    return table(spark, folder, "part").select(
        F.upper("p_name").alias("name"),
        F.col("p_type").alias("type"),
        F.col("p_brand").alias("description"),
        F.col("p_size").cast("string").alias("source_id"),
    )


@query(
    "a14_merge_entity_mentions",
    f"""
WITH {MENTIONS_SQL}, t AS (SELECT name, arg_min(type, (-n, type)) AS type, CAST(sum(n) AS BIGINT) AS mentions FROM (SELECT name, type, count(*) AS n FROM mentions GROUP BY ALL) GROUP BY name)
SELECT name, type, mentions, count(DISTINCT source_id) AS sources, string_agg(DISTINCT description, '<SEP>' ORDER BY description) AS description,
  string_agg(DISTINCT CAST(source_id AS VARCHAR), ',' ORDER BY CAST(source_id AS VARCHAR)) AS source_ids
FROM mentions m JOIN t USING (name) GROUP BY name, t.type, mentions
""".replace("SELECT name, type, mentions, count", "SELECT name, t.type AS type, mentions, count"),
)
def a14_merge_entity_mentions(spark, folder):
    return aggregates.merge_entity_mentions(part_mentions(spark, folder)).withColumn("source_ids", F.array_join("source_ids", ","))


@query(
    "a15_merge_relation_mentions",
    """
WITH r AS (
  SELECT least(n_name, p_brand) AS src, greatest(n_name, p_brand) AS dst, l_quantity AS weight, l_returnflag AS description, l_linestatus AS keywords, l_shipdate AS s
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN part ON p_partkey = l_partkey)
SELECT src, dst, sum(weight) AS weight, count(DISTINCT s) AS sources,
  string_agg(DISTINCT description, '<SEP>' ORDER BY description) AS description, string_agg(DISTINCT keywords, ',' ORDER BY keywords) AS keywords,
  md5(string_agg(DISTINCT strftime(s, '%Y-%m-%d'), ',' ORDER BY strftime(s, '%Y-%m-%d'))) AS source_ids
FROM r GROUP BY src, dst
""",
)
def a15_merge_relation_mentions(spark, folder):
    merged = aggregates.merge_relation_mentions(trade_mentions(spark, folder))
    days = F.transform("source_ids", lambda s: F.date_format(s, "yyyy-MM-dd"))
    return merged.withColumn("source_ids", F.md5(F.array_join(days, ",")))


def trade_mentions(spark, folder):
    """Supplier nation – part brand relations, one mention per line item."""
    lines = table(spark, folder, "lineitem").select(
        "l_suppkey", "l_partkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    nations = table(spark, folder, "supplier").join(
        table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).select(F.col("s_suppkey").alias("l_suppkey"), "n_name")
    brands = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return (
        lines.join(nations, "l_suppkey")
        .join(brands, "l_partkey")
        .select(
            F.col("p_brand").alias("src"),
            F.col("n_name").alias("dst"),
            F.col("l_quantity").alias("weight"),
            F.col("l_returnflag").alias("description"),
            F.col("l_linestatus").alias("keywords"),
            F.col("l_shipdate").alias("source_id"),
        )
    )


@query(
    "a16_table_metadata",
    """
SELECT 'p_type' AS "column", p_type AS value, min(p_partkey) AS first_row FROM part GROUP BY p_type
UNION ALL SELECT 'p_size', CAST(p_size AS VARCHAR), min(p_partkey) FROM part GROUP BY p_size
""",
)
def a16_table_metadata(spark, folder):
    return aggregates.table_metadata(table(spark, folder, "part"), ["p_type", "p_size"], "p_partkey")


@query(
    "a17_merge_doc_metadata",
    f"""
WITH {inp.CHUNKS_SQL}
SELECT doc_id, 'length' AS key, CAST(arg_max(length(content), ord) AS VARCHAR) AS value, max(ord) AS ord FROM chunks GROUP BY doc_id
UNION ALL SELECT doc_id, 'initial', left(content, 1), min(ord) FROM chunks GROUP BY doc_id, left(content, 1)
""",
)
def a17_merge_doc_metadata(spark, folder):
    chunks = inp.chunks(spark, folder)
    scalars = chunks.select("doc_id", "ord", F.lit("length").alias("key"), F.length("content").cast("string").alias("value"), F.lit(False).alias("listed"))
    lists = chunks.select("doc_id", "ord", F.lit("initial").alias("key"), F.left("content", F.lit(1)).alias("value"), F.lit(True).alias("listed"))
    return aggregates.merge_doc_metadata(scalars.unionByName(lists))


@query(
    "a18_message_stats",
    f"WITH {inp.MESSAGES_SQL} SELECT memory_id, max(turn) AS max_turn, count(*) AS n, strftime(max(valid_at), '%Y-%m-%d %H:%M:%S') AS latest FROM messages GROUP BY memory_id",
)
def a18_message_stats(spark, folder):
    return aggregates.message_stats(inp.messages(spark, folder)).withColumn(
        "latest", F.date_format("latest", "yyyy-MM-dd HH:mm:ss")
    )


@query(
    "a19_embedding_drift",
    """
WITH e AS (SELECT a.vec_id, CAST(a.embedding AS DOUBLE[]) AS old, CAST(b.embedding AS DOUBLE[]) AS title FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1),
f AS (SELECT old, title, list_transform(old, lambda x, i: x + 0.1 * title[i]) AS fresh FROM e),
s AS (SELECT greatest(list_cosine_similarity(old, fresh), list_cosine_similarity(old, list_transform(fresh, lambda x, i: 0.9 * x + 0.1 * title[i]))) AS similarity FROM f)
SELECT count(*) AS n, round(avg(similarity), 6) AS avg_similarity, round(min(similarity), 6) AS min_similarity, round(max(similarity), 6) AS max_similarity, avg(similarity) >= 0.9 AS compatible FROM s
""",
)
def a19_embedding_drift(spark, folder):
    vectors = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("chunk_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    titles = vectors.select((F.col("chunk_id") - 1).alias("chunk_id"), F.col("embedding").alias("title_vec"))
    fresh = vectors.join(titles, "chunk_id").select(
        "chunk_id",
        "title_vec",
        F.zip_with("embedding", "title_vec", lambda x, t: x + t * 0.1).alias("content_vec"),
    )
    return aggregates.embedding_drift(vectors, fresh)


@query(
    "a20_evaluation_summary",
    """
WITH r AS (
  SELECT source AS run_id, 'precision' AS metric, (doc_id % 10) / 10.0 AS value FROM documents
  UNION ALL SELECT source, 'recall', CASE WHEN n_chars > 300 THEN 1.0 ELSE 0.0 END FROM documents
  UNION ALL SELECT source, 'execution_time', n_chars / 400.0 FROM documents),
m AS (SELECT run_id, metric, avg(value) AS average, count(*) AS cases FROM r GROUP BY ALL)
SELECT run_id, metric, round(average, 6) AS average, cases, CASE WHEN metric = 'precision' AND round(average, 9) < 0.7 THEN 'Low Precision'
  WHEN metric = 'recall' AND round(average, 9) < 0.7 THEN 'Low Recall' WHEN metric = 'execution_time' AND round(average, 9) > 5 THEN 'Slow Response Time' END AS issue FROM m
""",
)
def a20_evaluation_summary(spark, folder):
    docs = table(spark, folder, "documents")
    metric = lambda name, v: F.struct(F.lit(name).alias("metric"), v.cast("double").alias("value"))
    rows = docs.select(
        F.col("source").alias("run_id"),
        F.col("doc_id").alias("case_id"),
        F.explode(
            F.array(
                metric("precision", (F.col("doc_id") % 10) / 10.0),
                metric("recall", F.when(F.col("n_chars") > 300, 1.0).otherwise(0.0)),
                metric("execution_time", F.col("n_chars") / 400.0),
            )
        ).alias("m"),
    ).select("run_id", "case_id", "m.*")
    return aggregates.evaluation_summary(rows)


@query(
    "a21_latency_summary",
    """
WITH o AS (SELECT event_type AS "group", value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS rn, count(*) OVER (PARTITION BY event_type) AS c FROM events)
SELECT "group", count(*) AS count, round(avg(value), 6) AS avg, min(value) AS min, max(value) AS max,
  min(value) FILTER (WHERE rn >= ceil(c * 50 / 100.0)) AS p50, min(value) FILTER (WHERE rn >= ceil(c * 90 / 100.0)) AS p90, min(value) FILTER (WHERE rn >= ceil(c * 95 / 100.0)) AS p95
FROM o GROUP BY "group"
""",
)
def a21_latency_summary(spark, folder):
    return aggregates.latency_summary(
        table(spark, folder, "events").select(F.col("event_type").alias("group"), "value")
    )


@query(
    "a22_type_samples",
    """
SELECT p_type AS type, string_agg(p_name, ',' ORDER BY p_name) AS names FROM (SELECT DISTINCT p_type, p_name FROM part QUALIFY dense_rank() OVER (PARTITION BY p_type ORDER BY p_name) <= 12) GROUP BY p_type
""",
)
def a22_type_samples(spark, folder):
    entities = table(spark, folder, "part").select(F.col("p_type").alias("type"), F.col("p_name").alias("name"))
    return aggregates.type_samples(entities, 12).withColumn("names", F.array_join("names", ","))


@query("a23_approx_usage")
def a23_approx_usage(spark, folder):
    """Sketched distinct users next to the exact number."""
    rows = conversation_rows(table(spark, folder, "events"))
    exact = aggregates.usage_stats(rows).select("day", F.col("uv").alias("exact"))
    return aggregates.approx_usage(rows).join(exact, "day").withColumn("day", F.date_format("day", "yyyy-MM-dd"))
