"""Filters, set operations, sorting and paging over the given tables (F, U, L ids)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import text as tx
from corvane.operators import filters, ordering, retrieval, sets
from corvane.plans import inputs as inp
from corvane.plans.registry import query, table


@query(
    "f1_chunk_filter",
    f"""
WITH {inp.CHUNKS_SQL}, c AS (SELECT chunks.*, quality AS available FROM chunks LEFT JOIN labels USING (doc_id))
SELECT chunk_id, doc_id, lang FROM c WHERE lang IN ('en', 'de') AND coalesce(available, 1) >= 1
""",
)
def f1_chunk_filter(spark, folder):
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("available"))
    flagged = inp.chunks(spark, folder).join(labels, "doc_id", "left")
    return flagged.filter(filters.chunk_filter({"lang": ["en", "de"], "source": "", "available": 1})).select(
        "chunk_id", "doc_id", "lang"
    )


@query("f2_array_filter", "SELECT doc_id FROM documents WHERE lang IN ('fr', 'es') OR source IN ('src3')")
def f2_array_filter(spark, folder):
    tagged = table(spark, folder, "documents").withColumn("tags", F.array("lang", "source"))
    return tagged.filter(filters.chunk_filter({"tags": ["fr", "es", "src3"]}, ["tags"])).select("doc_id")


@query(
    "f3_exists",
    "SELECT doc_id, CASE WHEN l.doc_id IS NULL THEN 'absent' ELSE 'present' END AS label FROM documents d LEFT JOIN labels l USING (doc_id)",
)
def f3_exists(spark, folder):
    joined = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    present = joined.filter(filters.chunk_filter({"exists": "quality"})).select("doc_id", F.lit("present").alias("label"))
    absent = joined.filter(filters.chunk_filter({"must_not_exist": "quality"})).select("doc_id", F.lit("absent").alias("label"))
    return present.unionByName(absent)


META_CASES = {
    "and": ([{"key": "lang", "op": "is", "value": "EN"}, {"key": "size", "op": "≥", "value": "1000"}, {"key": "source", "op": "not in", "value": ["SRC1", "src2"]}], "and"),
    "or": ([{"key": "tag", "op": "start with", "value": "SRC1"}, {"key": "quality", "op": "=", "value": 0}], "or"),
    "not_equal_any": ([{"key": "tag", "op": "≠", "value": "en"}], "and"),
    "absent_key": ([{"key": "quality", "op": "empty", "value": ""}, {"key": "nothing", "op": "≠", "value": "x"}], "or"),
    "substring": ([{"key": "lang", "op": "in", "value": "en,fr"}, {"key": "source", "op": "contains", "value": "RC1"}, {"key": "tag", "op": "end with", "value": "9"}], "and"),
    "not_contains": ([{"key": "source", "op": "not contains", "value": "1"}, {"key": "size", "op": "<", "value": 500}, {"key": "lang", "op": "not empty", "value": ""}], "and"),
}


@query(
    "f4_meta_filter",
    """
SELECT 'and' AS name, doc_id FROM documents WHERE lang = 'en' AND n_chars >= 1000 AND source NOT IN ('src1', 'src2')
UNION ALL SELECT 'or', doc_id FROM documents d WHERE starts_with(source, 'src1') OR EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND quality = 0)
UNION ALL SELECT 'not_equal_any', doc_id FROM documents
UNION ALL SELECT 'substring', doc_id FROM documents WHERE lang IN ('en', 'fr') AND contains(source, 'rc1') AND ends_with(source, '9')
UNION ALL SELECT 'not_contains', doc_id FROM documents WHERE NOT contains(source, '1') AND n_chars < 500
""",
)
def f4_meta_filter(spark, folder):
    meta = inp.metadata(spark, folder)
    return sets.concat_results(
        [filters.meta_filter(meta, f, logic).select(F.lit(name).alias("name"), "doc_id") for name, (f, logic) in META_CASES.items()]
    )


@query(
    "f5_date_filter",
    """
SELECT event_id FROM events WHERE event_type <> 'view' AND strftime(ts, '%Y-%m-%d') >= '2024-01-10' AND strftime(ts, '%Y-%m-%d') < '2024-01-20'
""",
)
def f5_date_filter(spark, folder):
    day = F.when(F.col("event_type") == "view", "sometime").otherwise(F.date_format("ts", "yyyy-MM-dd"))
    meta = table(spark, folder, "events").select(F.col("event_id").alias("doc_id"), F.lit("day").alias("key"), day.alias("value"))
    wanted = [{"key": "day", "op": ">=", "value": "2024-01-10"}, {"key": "day", "op": "<", "value": "2024-01-20"}]
    return filters.meta_filter(meta, wanted).withColumnRenamed("doc_id", "event_id")


@query(
    "f8_json_filter",
    """
SELECT 'and' AS name, event_id FROM events WHERE CAST(json_extract_string(props, '$.k') AS DOUBLE) > 20 AND CAST(json_extract_string(props, '$.k') AS DOUBLE) <= 60
UNION ALL SELECT 'or', event_id FROM events WHERE json_extract_string(props, '$.k') = '5'
UNION ALL SELECT 'time', event_id FROM events WHERE ts < TIMESTAMP '2024-01-05 00:00:00'
""",
)
def f8_json_filter(spark, folder):
    events = table(spark, folder, "events")
    timed = events.withColumn(
        "props", F.to_json(F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("at")))
    )
    named = lambda name, df: df.select(F.lit(name).alias("name"), "event_id")
    both = [{"name": "k", "op": ">", "value": 20}, {"name": "k", "op": "≤", "value": 60}]
    either = [{"name": "k", "op": "is", "value": "5"}, {"name": "missing", "op": "not empty"}]
    return sets.concat_results(
        [
            named("and", filters.json_filter(events, "props", both)),
            named("or", filters.json_filter(events, "props", either, "or")),
            named("time", filters.json_filter(timed, "props", [{"name": "at", "op": "before", "value": "2024-01-05 00:00:00"}])),
        ]
    )


@query(
    "f9_metadata_scope",
    f"""
WITH {inp.CHUNKS_SQL}
SELECT 'extended' AS name, chunk_id FROM chunks WHERE lang = 'fr' OR doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)
UNION ALL SELECT 'open', chunk_id FROM chunks
""",
)
def f9_metadata_scope(spark, folder):
    chunks, meta = inp.chunks(spark, folder), inp.metadata(spark, folder)
    toxic = table(spark, folder, "labels").filter("toxic = 1").select("doc_id")
    french = filters.metadata_scope(meta, [{"key": "lang", "op": "=", "value": "fr"}], base_ids=toxic)
    nothing = filters.metadata_scope(meta, [{"key": "lang", "op": "=", "value": "none"}])
    anything = filters.metadata_scope(meta, [])
    named = lambda name, scope: filters.restrict(chunks, scope).select(F.lit(name).alias("name"), "chunk_id")
    return sets.concat_results([named("extended", french), named("empty", nothing), named("open", anything)])


def event_records(spark, folder):
    return table(spark, folder, "events").select(
        "event_id",
        F.create_map(
            F.lit("type"), F.col("event_type"), F.lit("props"), F.col("props"), F.lit("user"), F.col("user_id").cast("string")
        ).alias("record"),
    )


@query(
    "f10_filter_values",
    "SELECT event_id FROM events WHERE starts_with(event_type, 'c') AND contains(props, '3') AND CAST(user_id AS VARCHAR) <> '8'",
)
def f10_filter_values(spark, folder):
    rules = [
        {"key": "type", "op": "start with", "value": "c"},
        {"key": "props", "op": "contains", "value": "3"},
        {"key": "user", "op": "≠", "value": 8},
    ]
    return filters.filter_values(event_records(spark, folder), "record", rules).select("event_id")


@query(
    "f11_route",
    """
SELECT event_id, CASE WHEN value > 100 AND event_type = 'purchase' THEN 'large'
  WHEN contains(event_type, 'err') OR value < 1 THEN 'review' ELSE 'rest' END AS route
FROM events
""",
)
def f11_route(spark, folder):
    value, kind = F.col("value"), F.col("event_type")
    choice = filters.route(
        [
            ("large", "and", [filters.route_test(value, ">", "100", numeric=True), filters.route_test(kind, "=", "purchase")]),
            ("review", "or", [filters.route_test(kind, "contains", "ERR"), filters.route_test(value, "<", "1", numeric=True)]),
        ],
        "rest",
    )
    return table(spark, folder, "events").select("event_id", choice.alias("route"))


@query(
    "f13_record_keys",
    """
SELECT event_id, 'props,type' AS selected, 'type,user' AS removed, 'kind=' || event_type AS renamed, 'x' || user_id AS updated FROM events
""",
)
def f13_record_keys(spark, folder):
    record = F.col("record")
    names = lambda m: F.array_join(F.array_sort(F.map_keys(m)), ",")
    renamed = filters.rename_keys(record, {"type": "kind"})
    updated = filters.append_or_update(record, {"user": F.concat(F.lit("x"), record["user"])})
    return event_records(spark, folder).select(
        "event_id",
        names(filters.select_keys(record, ["props", "type", "absent"])).alias("selected"),
        names(filters.remove_keys(record, ["props"])).alias("removed"),
        F.concat(F.lit("kind="), renamed["kind"]).alias("renamed"),
        updated["user"].alias("updated"),
    )


@query("f14_prune_orphans", f"WITH {inp.CHUNKS_SQL} SELECT chunk_id, doc_id FROM chunks WHERE doc_id IN (SELECT doc_id FROM labels)")
def f14_prune_orphans(spark, folder):
    hits = inp.chunks(spark, folder).select("chunk_id", "doc_id")
    return filters.prune_orphans(hits, table(spark, folder, "labels"))


@query(
    "f15_list_documents",
    """
SELECT doc_id FROM documents WHERE contains(lower(source || '.' || lang), 'src1') AND lang IN ('en', 'de') AND doc_id NOT IN (SELECT doc_id FROM labels)
""",
)
def f15_list_documents(spark, folder):
    docs = table(spark, folder, "documents").select(
        "doc_id", F.concat_ws(".", "source", "lang").alias("name"), F.col("lang").alias("suffix"), F.lit("1").alias("run"), F.lit("text").alias("type")
    )
    return filters.list_documents(
        docs, name_contains="SRC1", suffixes=["en", "de"], runs=["1"], without_metadata=table(spark, folder, "labels")
    ).select("doc_id")


@query(
    "f16_valid_messages",
    f"WITH {inp.MESSAGES_SQL} SELECT message_id FROM messages WHERE role <> 'system' AND forget_at IS NULL AND contains(CAST(memory_id AS VARCHAR), '2')",
)
def f16_valid_messages(spark, folder):
    messages = inp.messages(spark, folder).withColumns(
        {"status": (F.col("role") != "system").cast("int"), "session_id": F.col("memory_id").cast("string")}
    )
    return filters.valid_messages(messages, session_contains="2").select("message_id")


@query(
    "f17_needs_no_tree",
    """
SELECT page_id, ext, ext IN ('CSV', 'xlsx') OR (ext = 'pdf' AND page_id % 2 = 0) AS skip
FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'CSV' WHEN 1 THEN 'xlsx' WHEN 2 THEN 'pdf' ELSE 'html' END AS ext FROM pages)
""",
)
def f17_needs_no_tree(spark, folder):
    kind = F.element_at(F.array(F.lit("CSV"), F.lit("xlsx"), F.lit("pdf"), F.lit("html")), (F.col("page_id") % 4 + 1).cast("int"))
    skip = filters.needs_no_tree(F.col("ext"), F.when(F.col("page_id") % 2 == 0, "Table"), F.lit(False))
    return table(spark, folder, "pages").withColumn("ext", kind).select("page_id", "ext", skip.alias("skip"))


@query(
    "f18_toc_entries",
    f"""
WITH {inp.LINES_SQL},
e AS (SELECT doc_id, ord, line AS title, len({inp.sql_words('line')}) AS n, ord % 3 AS level, count(*) OVER (PARTITION BY doc_id) AS c FROM lines),
k AS (SELECT * FROM e WHERE title <> '' AND title <> '-1' AND n <= CASE WHEN c > 512 THEN 12 ELSE 22 END AND NOT regexp_matches(title, '^[0-9,.()/ -]+$'))
SELECT doc_id, CAST(ord AS BIGINT) AS ord FROM k QUALIFY count(*) OVER (PARTITION BY doc_id) <= 512 OR level < max(level) OVER (PARTITION BY doc_id)
""",
)
def f18_toc_entries(spark, folder):
    entries = inp.lines(spark, folder).select("doc_id", "ord", F.col("line").alias("title"), (F.col("ord") % 3).alias("level"))
    return filters.toc_entries(entries).select("doc_id", "ord")


@query(
    "u1_combine_ids",
    """
SELECT 'and' AS name, doc_id FROM documents WHERE lang = 'en' AND starts_with(source, 'src1')
UNION ALL SELECT 'or', doc_id FROM documents WHERE lang = 'en' OR starts_with(source, 'src1')
""",
)
def u1_combine_ids(spark, folder):
    docs = table(spark, folder, "documents")
    parts = [docs.filter("lang = 'en'").select("doc_id"), docs.filter(F.col("source").startswith("src1")).select("doc_id")]
    return sets.concat_results(
        [sets.combine_ids(parts, logic).select(F.lit(logic).alias("name"), "doc_id") for logic in ("and", "or")]
    )


@query(
    "u2_concat_results",
    """
SELECT doc_id AS id, lang, NULL::VARCHAR AS role FROM documents
UNION ALL SELECT conv_id, NULL, role FROM conversations
""",
)
def u2_concat_results(spark, folder):
    return sets.concat_results(
        [
            table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "lang"),
            table(spark, folder, "conversations").select(F.col("conv_id").alias("id"), "role"),
        ]
    )


@query(
    "u3_dedupe_list",
    f"""
WITH t AS (SELECT doc_id, {inp.sql_words('text')} AS w FROM documents)
SELECT doc_id, md5(array_to_string(list_filter(w, lambda x, i: list_position(w, x) = i), ' ')) AS distinct_words FROM t
""",
)
def u3_dedupe_list(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", F.md5(F.array_join(sets.dedupe_list(tx.words("text")), " ")).alias("distinct_words")
    )


@query("u4_insert_then_prune", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def u4_insert_then_prune(spark, folder):
    _, stale = sets.insert_then_prune(table(spark, folder, "documents"), table(spark, folder, "labels"), "doc_id")
    return stale


@query(
    "u5_digit_in_difference",
    r"""
WITH n AS (SELECT s_suppkey, s_name AS a, 'Supplier#' || lpad(CAST(s_suppkey // 2 AS VARCHAR), 9, '0') AS b FROM supplier),
g AS (SELECT *, list_distinct(list_transform(range(1, length(a)), lambda i: substr(a, i, 2))) AS ga,
             list_distinct(list_transform(range(1, length(b)), lambda i: substr(b, i, 2))) AS gb FROM n)
SELECT s_suppkey, len(list_filter(ga, lambda x: NOT list_contains(gb, x) AND regexp_matches(x, '[0-9]')))
  + len(list_filter(gb, lambda x: NOT list_contains(ga, x) AND regexp_matches(x, '[0-9]'))) > 0 AS differs FROM g
""",
)
def u5_digit_in_difference(spark, folder):
    other = F.concat(F.lit("Supplier#"), F.lpad(F.floor(F.col("s_suppkey") / 2).cast("string"), 9, "0"))
    return table(spark, folder, "supplier").select(
        "s_suppkey", sets.digit_in_difference(F.col("s_name"), other).alias("differs")
    )


@query("l1_order_by", "SELECT doc_id, lang, n_chars FROM documents")
def l1_order_by(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    return ordering.order_by(docs, [("lang", "asc"), ("no_such_field", "desc"), ("n_chars", "desc"), ("doc_id", "asc")])


@query("l2_page", "SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 25 OFFSET 50")
def l2_page(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "n_chars")
    return ordering.page(ordering.order_by(docs, [("n_chars", "desc"), ("doc_id", "asc")]), 3, 25)


@query(
    "l3_keyset_page",
    "SELECT event_type, event_id FROM events WHERE (event_type, event_id) > ('error', 500) ORDER BY event_type, event_id LIMIT 100",
)
def l3_keyset_page(spark, folder):
    events = table(spark, folder, "events").select("event_type", "event_id")
    return ordering.keyset_page(events, ["event_type", "event_id"], ("error", 500), 100)


@query(
    "l6_record_list",
    """
SELECT 'head' AS part, event_id FROM (SELECT event_id FROM events ORDER BY value, event_id LIMIT 5)
UNION ALL SELECT 'tail', event_id FROM (SELECT event_id FROM events ORDER BY value DESC, event_id DESC LIMIT 5)
UNION ALL SELECT 'third', event_id FROM (SELECT event_id FROM events ORDER BY value, event_id LIMIT 1 OFFSET 2)
UNION ALL SELECT 'last_but_one', event_id FROM (SELECT event_id FROM events ORDER BY value DESC, event_id DESC LIMIT 1 OFFSET 1)
UNION ALL SELECT 'first_of_user', min(event_id) FROM events GROUP BY user_id
""",
)
def l6_record_list(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "value")
    order = ["value", "event_id"]
    named = lambda name, df: df.select(F.lit(name).alias("part"), "event_id")
    return sets.concat_results(
        [
            named("head", ordering.head(events, order, 5)),
            named("tail", ordering.tail(events, order, 5)),
            named("third", ordering.nth(events, order, 3)),
            named("last_but_one", ordering.nth(events, order, -2)),
            named("first_of_user", ordering.drop_duplicates(events, ["user_id"], "event_id")),
        ]
    )


POSITION_SQL = """boxed AS (
  SELECT chunk_id, doc_id, ord, CASE WHEN ord % 7 <> 6 THEN [ord // 10 + 1, ord // 10 + 2] END AS page_no,
         [(ord * 37) % 100] AS top_edge, (ord * 11) % 50 AS left_edge FROM chunks)"""


def boxed_chunks(spark, folder):
    ord_ = F.col("ord")
    page = F.floor(ord_ / 10).cast("int")
    return inp.chunks(spark, folder).select(
        "chunk_id",
        "doc_id",
        "ord",
        F.when(ord_ % 7 != 6, F.array(page + 1, page + 2)).alias("page_no"),
        F.array(((ord_ * 37) % 100).cast("int")).alias("top_edge"),
        F.array(F.array(page + 1, ((ord_ * 11) % 50).cast("int"))).alias("pos"),
    )


@query(
    "w12_positional_order",
    f"""
WITH {inp.CHUNKS_SQL}, {POSITION_SQL}
SELECT chunk_id FROM boxed ORDER BY list_avg(page_no) ASC NULLS LAST, top_edge[1], left_edge, doc_id, ord
""",
)
def w12_positional_order(spark, folder):
    keys = ordering.positional_order(F.col("pos"), F.col("page_no"), F.col("top_edge"))
    return boxed_chunks(spark, folder).orderBy(*keys, "doc_id", "ord").select("chunk_id")


@query(
    "l8_document_chunks",
    f"""
WITH {inp.CHUNKS_SQL}, {POSITION_SQL}
SELECT doc_id, chunk_id, row_number() OVER (PARTITION BY doc_id ORDER BY list_avg(page_no) ASC NULLS LAST, top_edge[1], left_edge, ord) AS place
FROM boxed
""",
)
def l8_document_chunks(spark, folder):
    from pyspark.sql import Window

    keys = ordering.positional_order(F.col("pos"), F.col("page_no"), F.col("top_edge"))
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy(*keys, "ord"))
    return boxed_chunks(spark, folder).withColumn("place", place).select("doc_id", "chunk_id", "place")


@query(
    "r13_table_search",
    r"""
SELECT p_type, count(*) AS n, round(avg(p_retailprice), 4) AS price FROM part
WHERE len(list_intersect(['red', 'widget', 'small'], regexp_extract_all(lower(p_name), '[\p{L}\p{N}_]+'))) >= 1 GROUP BY p_type
""",
)
def r13_table_search(spark, folder):
    matched = table(spark, folder, "part").filter(
        retrieval.token_match(tx.words("p_name"), F.lit("Red small widget"))
    )
    return spark.sql("SELECT p_type, count(*) AS n, round(avg(p_retailprice), 4) AS price FROM {rows} GROUP BY p_type", rows=matched)
