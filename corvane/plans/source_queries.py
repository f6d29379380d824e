"""Sources, the chunk store, sync and streams over the given tables (S and ST ids, C23)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corvane.functions import text as tx
from corvane.operators import aggregates, chunking, tables
from corvane.plans import inputs as inp
from corvane.plans.aggregate_queries import USAGE_SQL, conversation_rows, trade_mentions
from corvane.plans.graph_queries import TRADE_SQL
from corvane.plans.registry import query, table
from corvane.session import shared_folder
from corvane.sources import documents, store, sync
from corvane.streaming import ingest, state


def fresh_folder(spark) -> str:
    """A new folder in the shared place, for a query that writes."""
    return f"{shared_folder(spark).rstrip('/')}/corvane-run-{uuid.uuid4().hex}"


@query("s1_read_chunks", f"WITH {inp.CHUNKS_SQL} SELECT chunk_id, doc_id, lang AS dataset_id FROM chunks WHERE lang IN ('de', 'fr')")
def s1_read_chunks(spark, folder):
    target = fresh_folder(spark)
    chunks = inp.chunks(spark, folder).withColumnRenamed("lang", "dataset_id")
    store.write_chunks(chunks.select("chunk_id", "doc_id", "content", "dataset_id"), target)
    return store.read_chunks(spark, target, ["de", "fr"]).select("chunk_id", "doc_id", "dataset_id")


@query(
    "s2_rows_to_documents",
    """
SELECT 'sql:shop:' || o_orderkey AS doc_id, o_orderpriority AS semantic_id,
  '【o_orderpriority】:' || chr(10) || o_orderpriority || chr(10) || chr(10) || '【o_orderstatus】:' || chr(10) || o_orderstatus AS content,
  CAST(o_custkey AS VARCHAR) AS customer, strftime(o_orderdate, '%Y-%m-%d') AS updated FROM orders
""",
)
def s2_rows_to_documents(spark, folder):
    rows = documents.rows_to_documents(
        table(spark, folder, "orders"), ["o_orderpriority", "o_orderstatus"], ["o_custkey"], "o_orderkey", "o_orderdate", "sql:shop"
    )
    return rows.select("doc_id", "semantic_id", "content", F.col("metadata")["o_custkey"].alias("customer"), F.date_format("updated_at", "yyyy-MM-dd").alias("updated"))


@query(
    "s2_rows_without_id",
    "SELECT 'sql:shop:' || md5('【p_name】:' || chr(10) || p_name) AS doc_id, count(*) AS n FROM part GROUP BY p_name",
)
def s2_rows_without_id(spark, folder):
    rows = documents.rows_to_documents(table(spark, folder, "part"), ["p_name"], source="sql:shop")
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


BOUNDS = ("2024-01-08 00:00:00", "2024-01-15 12:00:00")


def _moment(text):
    return F.lit(text).cast("timestamp_ntz")


@query("s3_incremental_rows", f"SELECT event_id FROM events WHERE ts > TIMESTAMP '{BOUNDS[0]}' AND ts <= TIMESTAMP '{BOUNDS[1]}'")
def s3_incremental_rows(spark, folder):
    events = table(spark, folder, "events")
    return documents.incremental_rows(events, "ts", _moment(BOUNDS[0]), _moment(BOUNDS[1])).select("event_id")


@query(
    "s4_max_cursor",
    "SELECT strftime(greatest((SELECT max(ts) FROM events), (SELECT max(o_orderdate) FROM orders), (SELECT max(l_shipdate) FROM lineitem)), '%Y-%m-%d %H:%M:%S') AS \"cursor\"",
)
def s4_max_cursor(spark, folder):
    parts = [
        table(spark, folder, "events").select("ts"),
        table(spark, folder, "orders").select(F.col("o_orderdate").alias("ts")),
        table(spark, folder, "lineitem").select(F.col("l_shipdate").alias("ts")),
    ]
    return documents.max_cursor(parts, "ts").select(F.date_format("cursor", "yyyy-MM-dd HH:mm:ss").alias("cursor"))


@query("s5_slim_snapshot", "SELECT doc_id FROM documents")
def s5_slim_snapshot(spark, folder):
    return documents.slim_snapshot(table(spark, folder, "documents"))


def page_listing(spark, folder):
    """Pages as listed objects, and what was stored: every fifth altered, every seventh unknown."""
    pages = table(spark, folder, "pages")
    listing = pages.select(
        F.col("url").alias("key"), "page_id", F.when(F.col("page_id") % 11 == 0, "").otherwise(F.md5("html")).alias("fingerprint"), (F.col("page_id") % 13 == 0).alias("deleted")
    )
    stored = pages.filter("page_id % 7 <> 0").select(
        F.col("url").alias("key"), F.when(F.col("page_id") % 5 == 0, "old").otherwise(F.md5("html")).alias("fingerprint"), "page_id"
    )
    return listing, stored


@query(
    "s6_listing_diff",
    """
SELECT page_id, CASE WHEN page_id % 11 <> 0 AND page_id % 7 <> 0 AND page_id % 5 <> 0 THEN 'skip' ELSE 'fetch' END AS action FROM pages WHERE page_id % 13 <> 0
""",
)
def s6_listing_diff(spark, folder):
    listing, stored = page_listing(spark, folder)
    keyed = listing.withColumn("key", F.concat_ws("|", "key", F.col("page_id").cast("string")))
    known = stored.select(F.concat_ws("|", "key", F.col("page_id").cast("string")).alias("key"), "fingerprint")
    return sync.listing_diff(keyed, known).select("page_id", "action")


@query("s7_stale_documents", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def s7_stale_documents(spark, folder):
    existing = documents.slim_snapshot(table(spark, folder, "documents"))
    return sync.stale_documents(existing, documents.slim_snapshot(table(spark, folder, "labels")))


@query(
    "s8_sync_classify",
    """
SELECT user_id AS doc_id, CASE WHEN user_id IN (SELECT user_id FROM events WHERE event_type = 'signup') THEN 'updated' ELSE 'added' END AS change,
  strftime((SELECT max(ts) FROM events WHERE event_type <> 'signup'), '%Y-%m-%d %H:%M:%S') AS next_update
FROM events WHERE event_type <> 'signup' GROUP BY user_id
""",
)
def s8_sync_classify(spark, folder):
    events = table(spark, folder, "events")
    batch = events.filter("event_type <> 'signup'").groupBy(F.col("user_id").alias("doc_id")).agg(F.max("ts").alias("updated_at"))
    known = events.filter("event_type = 'signup'").select(F.col("user_id").alias("doc_id"))
    marked, cursor = sync.sync_classify(batch, known)
    seen = sync.advance(_moment("2020-01-01 00:00:00"), cursor.scalar())
    return marked.select("doc_id", "change", F.date_format(seen, "yyyy-MM-dd HH:mm:ss").alias("next_update"))


@query(
    "s9_map_json_items",
    """
SELECT CAST(conv_id AS VARCHAR) || '-' || turn AS doc_id, role || ': ' || text AS content, CAST(turn AS VARCHAR) AS turn
FROM conversations WHERE turn > 0 AND turn <= 5
""",
)
def s9_map_json_items(spark, folder):
    stamp = F.concat(F.lit("2024-01-0"), (F.col("turn") + 1).cast("string"), F.lit("T00:00:00Z"))
    item = F.struct(
        F.concat_ws("-", "conv_id", "turn").alias("id"), F.struct("role", "text").alias("body"), "turn", stamp.alias("at")
    )
    payloads = table(spark, folder, "conversations").select(F.to_json(F.struct(F.struct(F.array(item).alias("items")).alias("data"))).alias("payload"))
    rows = documents.map_json_items(
        payloads, "data.items", ["body.role", "body.text"], ["turn"], "id", "at", "{body.role}: {body.text}",
        F.lit("2024-01-01T00:00:00Z").cast("timestamp"), F.lit("2024-01-06T00:00:00Z").cast("timestamp"),
    )
    return rows.select("doc_id", "content", F.col("metadata")["turn"].alias("turn"))


@query(
    "s10_map_feed_entries",
    """
SELECT md5('http://feed' || chr(1) || url || page_id) AS doc_id, 'Page ' || page_id AS title, 'Page ' || page_id || chr(10) || chr(10) || 'Text of ' || page_id AS content, '2024-02-03 04:05:06' AS at FROM pages
""",
)
def s10_map_feed_entries(spark, folder):
    link = F.replace(F.concat("url", F.col("page_id").cast("string")), F.lit("&"), F.lit("&amp;"))
    xml = F.concat(
        F.lit("<rss><channel><item><guid></guid><link>"), link, F.lit("</link><title>Page "), "page_id",
        F.lit("</title><description>&lt;p&gt;Text of&lt;/p&gt; &lt;b&gt;"), "page_id",
        F.lit("&lt;/b&gt;</description><pubDate>Sat, 03 Feb 2024 04:05:06 +0000</pubDate></item></channel></rss>"),
    )
    feeds = table(spark, folder, "pages").select(F.lit("http://feed").alias("url"), xml.alias("xml"))
    rows = documents.map_feed_entries(feeds)
    at = F.date_format(F.to_utc_timestamp("updated_at", F.current_timezone()), "yyyy-MM-dd HH:mm:ss")
    return rows.select("doc_id", "title", "content", at.alias("at"))


@query(
    "s11_split_delimited",
    """
SELECT CASE WHEN event_id % 9 = 0 THEN 'rejected' ELSE 'row' END AS kind, CASE WHEN event_id % 9 <> 0 THEN event_type END AS event_type, count(*) AS n FROM events GROUP BY ALL
""",
)
def s11_split_delimited(spark, folder):
    lines = table(spark, folder, "events").select(
        F.concat_ws("\t", "event_id", "event_type", F.when(F.col("event_id") % 9 != 0, F.col("user_id").cast("string"))).alias("value")
    )
    rows, rejected = documents.split_delimited(lines, ["event_id", "event_type", "user_id"])
    return rows.groupBy(F.lit("row").alias("kind"), "event_type").agg(F.count(F.lit(1)).alias("n")).unionByName(
        rejected.agg(F.count(F.lit(1)).alias("n")).select(F.lit("rejected").alias("kind"), F.lit(None).cast("string").alias("event_type"), "n")
    )


@query(
    "s12_merge_tables",
    """
SELECT doc_id, lang, quality, tokens FROM (SELECT doc_id, lang FROM documents) FULL JOIN (SELECT doc_id, CAST(quality AS BIGINT) AS quality FROM labels) USING (doc_id)
FULL JOIN (SELECT conv_id AS doc_id, count(*) AS tokens FROM conversations GROUP BY conv_id) USING (doc_id)
""",
)
def s12_merge_tables(spark, folder):
    turns = table(spark, folder, "conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.count(F.lit(1)).alias("tokens"))
    return documents.merge_tables(
        [table(spark, folder, "documents").select("doc_id", "lang"), table(spark, folder, "labels").select("doc_id", "quality"), turns], "join", "doc_id"
    )


def doc_chunks(spark, folder):
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("chunk_id"), F.md5("text").alias("content"), F.lit(1).alias("version"), F.col("lang").alias("dataset_id")
    )


WRITTEN_SQL = """
SELECT doc_id AS chunk_id, CASE WHEN doc_id % 4 = 0 THEN 'new' ELSE md5(text) END AS content, CAST(CASE WHEN doc_id % 4 = 0 THEN 3 ELSE 1 END AS BIGINT) AS version, lang AS dataset_id FROM documents
"""


@query("s13_write_chunks", WRITTEN_SQL)
def s13_write_chunks(spark, folder):
    target = fresh_folder(spark)
    store.write_chunks(doc_chunks(spark, folder), target)
    changed = doc_chunks(spark, folder).filter("chunk_id % 4 = 0")
    twice = changed.withColumns({"content": F.lit("draft"), "version": F.lit(2)}).unionByName(
        changed.withColumns({"content": F.lit("new"), "version": F.lit(3)})
    )
    store.write_chunks(twice, target, order="version")
    return store.read_chunks(spark, target).select("chunk_id", "content", "version", "dataset_id")


@query(
    "s14_update_chunks",
    """
SELECT doc_id, CASE WHEN lang = 'en' THEN 'seen,' || source || ',en,new' ELSE 'seen,' || source || ',' || lang END AS tags,
  CASE WHEN lang = 'en' THEN 1.5::DOUBLE ELSE 0.5::DOUBLE END AS pagerank, CASE WHEN lang <> 'en' THEN source END AS note FROM documents
""",
)
def s14_update_chunks(spark, folder):
    chunks = table(spark, folder, "documents").select(
        "doc_id", "lang", F.array(F.lit("seen"), F.when(F.col("lang") == "en", "old").otherwise("seen"), "source", "lang").alias("tags"), F.lit(0.5).alias("pagerank"), F.col("source").alias("note")
    )
    updated = store.update_chunks(chunks, F.col("lang") == "en", {"pagerank": F.lit(1.5)}, {"tags": F.lit("new")}, None, ["note"])
    cleaned = store.update_chunks(updated, F.lit(True), remove={"tags": F.when(F.col("lang") == "en", "old").otherwise("seen")})
    return cleaned.select("doc_id", F.array_join("tags", ",").alias("tags"), "pagerank", "note")


@query("s15_delete_chunks", "SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE NOT (quality IS NOT NULL AND lang IN ('en', 'de'))")
def s15_delete_chunks(spark, folder):
    joined = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    return store.delete_chunks(joined, F.col("quality").isNotNull() & F.col("lang").isin("en", "de")).select("doc_id")


@query(
    "s16_get_by_id",
    """
SELECT vec_id AS chunk_id, CAST(CASE WHEN vec_id % 3 = 0 THEN 0 ELSE round(list_sum(CAST(embedding AS DOUBLE[])), 6) END AS DOUBLE) AS total FROM embeddings WHERE vec_id IN (SELECT doc_id FROM labels)
""",
)
def s16_get_by_id(spark, folder):
    vectors = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("chunk_id"), F.when(F.col("vec_id") % 3 == 0, F.slice("embedding", 1, 10)).otherwise(F.col("embedding")).alias("embedding")
    )
    wanted = table(spark, folder, "labels").select(F.col("doc_id").alias("chunk_id"))
    found = store.vectors_by_id(vectors, wanted, 64)
    return found.select("chunk_id", F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double")).alias("total"))


@query(
    "s17_reuse_by_digest",
    """
SELECT doc_id, CASE WHEN doc_id % 2 = 0 AND doc_id % 3 <> 0 AND lang = 'en' THEN 'ids' || doc_id END AS reused FROM documents
""",
)
def s17_reuse_by_digest(spark, folder):
    docs = table(spark, folder, "documents")
    tasks = docs.select("doc_id", sync.digest([F.col("doc_id"), F.col("lang"), F.lit("size=128")]).alias("digest"), F.lit(0).alias("start"))
    previous = docs.filter("doc_id % 2 = 0").select(
        sync.digest([F.col("doc_id"), F.lit("en"), F.lit("size=128")]).alias("digest"),
        F.lit(0).alias("start"),
        F.when(F.col("doc_id") % 3 == 0, 0.5).otherwise(1.0).alias("progress"),
        F.concat(F.lit("ids"), "doc_id").alias("chunk_ids"),
    )
    return sync.reuse_by_digest(tasks, previous).select("doc_id", "reused")


@query(
    "c23_build_docs_from_sources",
    rf"""
WITH d AS (SELECT 'sql:shop:' || p_partkey AS doc_id, chr(10) || '【p_name】:' || chr(10) || p_name || chr(10) || chr(10) || '【p_type】:' || chr(10) || p_type AS content, p_brand FROM part)
SELECT md5(content || chr(1) || doc_id || chr(1) || 0) AS chunk_id, doc_id, p_brand AS dataset_id, array_to_string({inp.sql_words('content')}, ' ') AS tokens FROM d
""",
)
def c23_build_docs_from_sources(spark, folder):
    docs = documents.rows_to_documents(table(spark, folder, "part"), ["p_name", "p_type"], ["p_brand"], "p_partkey", source="sql:shop")
    chunks = chunking.chunk_by_tokens(docs.select("doc_id", F.col("content").alias("text")), 128)
    indexed = tables.index_columns(chunks).join(docs.select("doc_id", F.col("metadata")["p_brand"].alias("dataset_id")), "doc_id")
    rows = indexed.select(tx.stable_id(F.col("content"), F.col("doc_id"), F.col("chunk")).alias("chunk_id"), "doc_id", "content", "tokens", "dataset_id")
    target = fresh_folder(spark)
    store.write_chunks(rows, target)
    return store.read_chunks(spark, target).select("chunk_id", "doc_id", "dataset_id", F.array_join("tokens", " ").alias("tokens"))


def event_stream(spark, folder):
    return ingest.read_files(spark, folder, table(spark, folder, "events").schema, "events.parquet")


@query(
    "st1_stream_ingest",
    "SELECT 'log:events:' || event_id AS doc_id, '【event_type】:' || chr(10) || event_type || chr(10) || chr(10) || '【props】:' || chr(10) || props AS content FROM events",
)
def st1_stream_ingest(spark, folder):
    run = fresh_folder(spark)
    to_documents = lambda rows: documents.rows_to_documents(rows, ["event_type", "props"], [], "event_id", "ts", "log:events")
    for _ in range(2):  # the second start finds nothing new
        ingest.stream_ingest(event_stream(spark, folder), to_documents, f"{run}/docs", f"{run}/checkpoint")
    return spark.read.parquet(f"{run}/docs").select("doc_id", "content")


@query(
    "st2_checkpointed_load",
    "SELECT event_id, event_type <> 'error' AS loaded FROM events",
)
def st2_checkpointed_load(spark, folder):
    run = fresh_folder(spark)
    broken = F.when(F.col("event_type") == "error", F.lit("{broken")).otherwise(F.col("props"))
    parse = lambda rows: rows.withColumn("parsed", F.try_parse_json(broken)).withColumn("failed", F.col("parsed").isNull()).drop("parsed")
    ingest.checkpointed_load(event_stream(spark, folder), parse, "failed", f"{run}/docs", f"{run}/errors", f"{run}/checkpoint")
    return spark.read.parquet(f"{run}/docs").select("event_id", F.lit(True).alias("loaded")).unionByName(
        spark.read.parquet(f"{run}/errors").select("event_id", F.lit(False).alias("loaded"))
    )


@query("st3_idempotent_upsert", "SELECT event_id AS chunk_id, event_type AS dataset_id, value FROM events")
def st3_idempotent_upsert(spark, folder):
    run = fresh_folder(spark)
    rows = lambda: event_stream(spark, folder).select(
        F.col("event_id").alias("chunk_id"), F.col("event_type").alias("dataset_id"), "value", F.col("ts").cast("timestamp").alias("at")
    )
    doubled = rows().unionByName(rows())
    ingest.idempotent_upsert(doubled, f"{run}/chunks", f"{run}/first")
    ingest.idempotent_upsert(rows(), f"{run}/chunks", f"{run}/second")
    return store.read_chunks(spark, f"{run}/chunks").select("chunk_id", "dataset_id", "value")


@query(
    "st4_memory_state",
    f"""
WITH {inp.MESSAGES_SQL}, s AS (SELECT memory_id % 5 AS memory_id, message_id, valid_at, octet_length(encode(content)) AS size FROM messages),
r AS (SELECT *, sum(size) OVER (PARTITION BY memory_id ORDER BY valid_at DESC, message_id DESC) AS newer FROM s)
SELECT memory_id, count(*) FILTER (WHERE newer <= 20000) AS kept, CAST(sum(size) FILTER (WHERE newer <= 20000) AS BIGINT) AS kept_bytes, count(*) FILTER (WHERE newer > 20000) AS forgotten FROM r GROUP BY memory_id
""",
)
def st4_memory_state(spark, folder):
    run = fresh_folder(spark)
    rows = inp.messages(spark, folder).select(
        (F.col("memory_id") % 5).alias("memory_id"), "message_id", F.col("valid_at").cast("timestamp").alias("valid_at"), aggregates.message_size(F.col("content")).alias("size")
    )
    rows.write.parquet(f"{run}/in")
    stream = ingest.read_files(spark, f"{run}/in", rows.schema)
    kept = state.memory_state(stream, 20000)
    write = lambda batch, n: batch.withColumn("batch", F.lit(n)).write.mode("overwrite").parquet(f"{run}/out/part={n}")
    writer = kept.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{run}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    out = spark.read.parquet(f"{run}/out")
    last = F.max_by(F.struct("kept", "kept_bytes", "forgotten"), "batch").alias("s")
    return out.groupBy("memory_id").agg(last).select("memory_id", "s.*")


@query("st5_usage_stats_stream", USAGE_SQL.replace("count(DISTINCT user_id) AS uv,", ""))
def st5_usage_stats_stream(spark, folder):
    run = fresh_folder(spark)
    as_utc = F.from_utc_timestamp(F.col("created_at").cast("timestamp"), F.current_timezone())
    rows = conversation_rows(event_stream(spark, folder)).withColumn("created_at", as_utc)
    write = lambda batch, n: batch.write.mode("overwrite").parquet(f"{run}/out")
    writer = ingest.usage_stats_stream(rows).writeStream.outputMode("complete").foreachBatch(write)
    writer.option("checkpointLocation", f"{run}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{run}/out").drop("uv").withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("st6_prune_stream", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def st6_prune_stream(spark, folder):
    run = fresh_folder(spark)
    snapshots = ingest.read_files(spark, folder, table(spark, folder, "labels").schema, "labels.parquet")
    ingest.prune_stream(snapshots, lambda: table(spark, folder, "documents").select("doc_id"), f"{run}/removed", f"{run}/checkpoint")
    return spark.read.parquet(f"{run}/removed").select("doc_id")


@query("st7_graph_increment", f"WITH {TRADE_SQL} SELECT src, dst, CAST(sum(weight) AS DOUBLE) AS weight FROM trade_lines GROUP BY src, dst")
def st7_graph_increment(spark, folder):
    run = fresh_folder(spark)
    rows = trade_mentions(spark, folder).select("src", "dst", "weight", F.col("description").alias("flag"))
    rows.write.partitionBy("flag").parquet(f"{run}/in")
    stream = ingest.read_files(spark, f"{run}/in", rows.schema, files_per_batch=2)
    merge = lambda batch: batch.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))
    ingest.graph_increment(stream, merge, f"{run}/graph", f"{run}/checkpoint")
    return spark.read.parquet(f"{run}/graph").groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


@query("st8_phase_resume", "SELECT doc_id, phase FROM documents, (SELECT unnest(['chunk', 'embed']) AS phase) p WHERE NOT (phase = 'chunk' AND doc_id % 2 = 0) AND NOT (phase = 'embed' AND doc_id % 6 = 0)")
def st8_phase_resume(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", sync.digest([F.col("doc_id"), F.lit("v1")]).alias("digest"))
    units = docs.withColumn("phase", F.explode(F.array(F.lit("chunk"), F.lit("embed"))))
    finished = docs.filter("doc_id % 2 = 0").withColumn("phase", F.lit("chunk")).unionByName(
        docs.filter("doc_id % 6 = 0").withColumn("phase", F.lit("embed"))
    )
    return ingest.phase_resume(units, finished).select("doc_id", "phase")
