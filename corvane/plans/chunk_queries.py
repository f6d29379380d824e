"""Chunking jobs over documents, pages and table rows (C ids, W6, W7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import text as tx
from corvane.operators import chunking, tables
from corvane.plans import inputs as inp
from corvane.plans.registry import query, table


def documents(spark, folder):
    return table(spark, folder, "documents").select("doc_id", "text")


def merged_sql(limit: float) -> str:
    """Lines merged until a chunk has passed the limit: ``merged(doc_id, chunk, content)``."""
    return f"""{inp.LINES_SQL}, t AS (SELECT doc_id, ord, line, {inp.sql_token_count('line')} AS n FROM lines),
g AS (SELECT doc_id, ord, 0 AS grp, n AS tot FROM t WHERE ord = 0
  UNION ALL SELECT t.doc_id, t.ord, CASE WHEN g.tot > {limit} THEN grp + 1 ELSE grp END, CASE WHEN g.tot > {limit} THEN t.n ELSE g.tot + t.n END
  FROM g JOIN t ON t.doc_id = g.doc_id AND t.ord = g.ord + 1),
merged AS (SELECT doc_id, CAST(grp AS BIGINT) AS chunk, string_agg(chr(10) || line, '' ORDER BY g.ord) AS content FROM g JOIN t USING (doc_id, ord) GROUP BY doc_id, grp)"""


def overlapped_sql(overlap: int) -> str:
    """Each chunk opens with the last share of the one before, which has its own: ``lapped(doc_id, chunk, content)``."""
    return f"""lapped AS (SELECT doc_id, chunk, content FROM merged WHERE chunk = 0
  UNION ALL SELECT m.doc_id, m.chunk, substr(l.content, CAST(floor(length(l.content) * {100 - overlap} / 100.0) AS BIGINT) + 1) || m.content
  FROM lapped l JOIN merged m ON m.doc_id = l.doc_id AND m.chunk = l.chunk + 1)"""


CHUNK_DIGEST_SQL = "SELECT doc_id, chunk, md5(content) AS content FROM"


MERGE_SQL = f"""
WITH RECURSIVE {inp.LINES_SQL}, t AS (SELECT doc_id, ord, line, {inp.sql_token_count('line')} AS n FROM lines),
g AS (SELECT doc_id, ord, 0 AS grp, n AS tot FROM t WHERE ord = 0
  UNION ALL SELECT t.doc_id, t.ord, CASE WHEN g.tot > 128 THEN grp + 1 ELSE grp END, CASE WHEN g.tot > 128 THEN t.n ELSE g.tot + t.n END
  FROM g JOIN t ON t.doc_id = g.doc_id AND t.ord = g.ord + 1)
"""


@query(
    "c1_chunk_by_tokens",
    MERGE_SQL
    + "SELECT doc_id, CAST(grp AS BIGINT) AS chunk, md5(string_agg(chr(10) || line, '' ORDER BY g.ord)) AS content FROM g JOIN t USING (doc_id, ord) GROUP BY doc_id, grp",
)
def c1_chunk_by_tokens(spark, folder):
    return chunking.chunk_by_tokens(documents(spark, folder), 128).withColumn("content", F.md5("content"))


@query("c1_chunk_with_overlap", f"WITH RECURSIVE {merged_sql(128 * 0.8)}, {overlapped_sql(20)} {CHUNK_DIGEST_SQL} lapped")
def c1_chunk_with_overlap(spark, folder):
    return chunking.chunk_by_tokens(documents(spark, folder), 128, overlap=20).withColumn("content", F.md5("content"))


@query(
    "c2_chunk_by_delimiter",
    r"""
WITH p AS (SELECT doc_id, list_filter(regexp_extract_all(text, '[^.;]*[.;]|[^.;]+'), lambda x: regexp_matches(x, '\S')) AS k FROM documents)
SELECT doc_id, generate_subscripts(k, 1) - 1 AS chunk, unnest(k) AS content FROM p
""",
)
def c2_chunk_by_delimiter(spark, folder):
    return chunking.chunk_by_delimiter(documents(spark, folder), [".", ";"])


@query(
    "c3_chunk_text",
    rf"""
WITH RECURSIVE p AS (SELECT doc_id, regexp_split_to_array(text, '[\n!?;。；！？]') AS k FROM documents),
t AS (SELECT doc_id, unnest(k) AS line, generate_subscripts(k, 1) - 1 AS ord FROM p),
c AS (SELECT *, {inp.sql_token_count('line')} AS n FROM t),
g AS (SELECT doc_id, ord, 0 AS grp, n AS tot FROM c WHERE ord = 0
  UNION ALL SELECT c.doc_id, c.ord, CASE WHEN g.tot > 100 THEN grp + 1 ELSE grp END, CASE WHEN g.tot > 100 THEN c.n ELSE g.tot + c.n END
  FROM g JOIN c ON c.doc_id = g.doc_id AND c.ord = g.ord + 1)
SELECT doc_id, CAST(grp AS BIGINT) AS chunk, md5(string_agg(line, chr(10) ORDER BY g.ord)) AS content FROM g JOIN c USING (doc_id, ord) GROUP BY doc_id, grp
""",
)
def c3_chunk_text(spark, folder):
    return chunking.chunk_text(documents(spark, folder), 100).withColumn("content", F.md5("content"))


def typed_items(spark, folder):
    """Document lines as typed items: a line with a bar is a table, others are text."""
    kind = lambda s: F.when(s.contains("|"), "table").otherwise("text")
    return documents(spark, folder).select(
        "doc_id", F.transform(F.split("text", "\n"), lambda s: F.struct(kind(s).alias("kind"), s.alias("text"))).alias("items")
    )


@query("c4_merge_adjacent")
def c4_merge_adjacent(spark, folder):
    return chunking.merge_adjacent(typed_items(spark, folder), 128, 10).withColumn("content", F.md5("content"))


@query(
    "c5_split_children",
    rf"""
WITH {inp.LINES_SQL},
p AS (SELECT doc_id, md5(line || chr(1) || doc_id) AS parent_id, list_filter(regexp_extract_all(line, '[^.,]*[.,]|[^.,]+'), lambda x: regexp_matches(x, '\S')) AS k
  FROM lines WHERE regexp_matches(line, '\S')),
c AS (SELECT doc_id, parent_id, generate_subscripts(k, 1) - 1 AS child, unnest(k) AS content FROM p)
SELECT 'child' AS kind, doc_id, parent_id, child, content FROM c
UNION ALL SELECT DISTINCT 'parent', doc_id, parent_id, -1, NULL FROM c
""",
)
def c5_split_children(spark, folder):
    lines = inp.lines(spark, folder).select("doc_id", F.col("line").alias("content"))
    children, parents = chunking.split_children(lines, [".", ","])
    return children.select(F.lit("child").alias("kind"), "doc_id", "parent_id", F.col("child").cast("bigint").alias("child"), "content").unionByName(
        parents.select(F.lit("parent").alias("kind"), "doc_id", "parent_id", F.lit(-1).cast("bigint").alias("child"), F.lit(None).cast("string").alias("content"))
    )


@query("c6_one_chunk", r"SELECT doc_id, CAST(0 AS BIGINT) AS chunk, md5(text) AS content FROM documents WHERE regexp_matches(text, '\S')")
def c6_one_chunk(spark, folder):
    return chunking.one_chunk(documents(spark, folder)).withColumn("content", F.md5("content"))


# Heading families that occur in the given texts.
PROSE_FAMILIES = (("Th", "An", "[A-Z][a-z]{0,2} "), ("[ÉÈ]", "Le", "Un"), ("[A-Z][a-z]+ que", "Que", "El"))


@query("c7_chunk_by_titles")
def c7_chunk_by_titles(spark, folder):
    return chunking.chunk_by_titles(documents(spark, folder), "group", families=PROSE_FAMILIES).withColumn("content", F.md5("content"))


@query("c8_chunk_by_hierarchy")
def c8_chunk_by_hierarchy(spark, folder):
    return chunking.chunk_by_titles(documents(spark, folder), "hierarchy", nth=2, families=PROSE_FAMILIES).withColumn("content", F.md5("content"))


def _family_sql(families):
    hit = lambda f: (
        "len(list_filter(ls, lambda s: regexp_matches(trim(s), '^(" + "|".join(f"({p})" for p in f) + ")') AND NOT regexp_matches(trim(s), '"
        + chunking.FALSE_HEADING + "')))"
    )
    return "[" + ", ".join(hit(f) for f in families) + "]"


@query(
    "c9_bullet_family",
    f"""
WITH h AS (SELECT doc_id, {_family_sql(PROSE_FAMILIES)} AS a, {_family_sql(chunking.HEADING_FAMILIES)} AS b FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))
SELECT doc_id, CAST(CASE WHEN list_max(a) > 0 THEN list_position(a, list_max(a)) - 1 ELSE -1 END AS BIGINT) AS prose,
  CAST(CASE WHEN list_max(b) > 0 THEN list_position(b, list_max(b)) - 1 ELSE -1 END AS BIGINT) AS standard FROM h
""",
)
def c9_bullet_family(spark, folder):
    lines = F.split("text", "\n")
    return documents(spark, folder).select(
        "doc_id", chunking.bullet_family(lines, PROSE_FAMILIES).alias("prose"), chunking.bullet_family(lines).alias("standard")
    )


@query("c10_drop_contents_pages", "SELECT doc_id, md5(text) AS content FROM documents")
def c10_drop_contents_pages(spark, folder):
    """Each document behind a made contents list that repeats its first line."""
    first = F.element_at(F.split("text", "\n"), 1)
    listed = documents(spark, folder).withColumn("text", F.concat(F.lit("Contents\n"), first, F.lit("\nOther entry\n"), F.col("text")))
    return chunking.drop_contents_pages(listed).withColumn("content", F.md5("content"))


@query("c11_html_to_sections")
def c11_html_to_sections(spark, folder):
    return chunking.html_to_sections(table(spark, folder, "pages"), 128)


@query(
    "c12_html_tables",
    rf"""
WITH RECURSIVE {inp.LINES_SQL}, t AS (SELECT doc_id, ord, '<tr><td>' || line || '</td></tr>' AS r FROM lines),
c AS (SELECT *, len({inp.sql_words('r')}) AS n FROM t),
g AS (SELECT doc_id, ord, 0 AS grp, n AS tot FROM c WHERE ord = 0
  UNION ALL SELECT c.doc_id, c.ord, CASE WHEN g.tot + c.n > 150 THEN grp + 1 ELSE grp END, CASE WHEN g.tot + c.n > 150 THEN c.n ELSE g.tot + c.n END
  FROM g JOIN c ON c.doc_id = g.doc_id AND c.ord = g.ord + 1)
SELECT doc_id, CAST(0 AS BIGINT) AS "table", CAST(grp AS BIGINT) AS chunk, md5('<table>' || string_agg(r, '' ORDER BY g.ord) || '</table>') AS content
FROM g JOIN c USING (doc_id, ord) GROUP BY doc_id, grp
""",
)
def c12_html_tables(spark, folder):
    rows = F.transform(F.split("text", "\n"), lambda s: F.concat(F.lit("<tr><td>"), s, F.lit("</td></tr>")))
    pages = documents(spark, folder).select("doc_id", F.concat(F.lit("<table>"), F.array_join(rows, ""), F.lit("</table>")).alias("html"))
    return chunking.html_tables(pages, 150, key="doc_id").withColumn("content", F.md5("content"))


@query("c13_json_to_chunks")
def c13_json_to_chunks(spark, folder):
    docs = table(spark, folder, "documents").select(
        "doc_id", F.to_json(F.struct("lang", "source", F.split("text", "\n").alias("lines"))).alias("text")
    )
    return chunking.json_to_chunks(docs, 400).withColumn("content", F.md5("content"))


@query("c14_markdown_elements")
def c14_markdown_elements(spark, folder):
    headed = documents(spark, folder).withColumn("text", F.concat(F.lit("# Title\n"), F.regexp_replace("text", "\n([A-Z])", "\n\n- $1")))
    return chunking.markdown_elements(headed).withColumn("content", F.md5("content"))


@query(
    "c15_qa_pairs",
    f"""
WITH {inp.LINES_SQL},
m AS (SELECT doc_id, ord, line, string_split(line, ',') AS p, sum(CASE WHEN len(string_split(line, ',')) = 2 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY ord) AS item FROM lines),
j AS (SELECT doc_id, item, max(CASE WHEN len(p) = 2 THEN p[1] END) AS question,
  max(CASE WHEN len(p) = 2 THEN p[2] END) || coalesce(string_agg(chr(10) || line, '' ORDER BY ord) FILTER (WHERE len(p) <> 2), '') AS answer FROM m WHERE item > 0 GROUP BY doc_id, item)
SELECT doc_id, CAST(item AS BIGINT) AS item, question, md5(answer) AS answer FROM j WHERE question <> ''
QUALIFY answer <> md5('') OR item = max(item) OVER (PARTITION BY doc_id)
""",
)
def c15_qa_pairs(spark, folder):
    return tables.qa_pairs(comma_lines(spark, folder)).withColumn("answer", F.md5("answer"))


def comma_lines(spark, folder):
    """Lines of the documents; a document without any comma pair would fall to tabs, of which there are none."""
    return inp.lines(spark, folder).select("doc_id", "ord", "line")


@query(
    "c16_tag_pairs",
    f"""
WITH {inp.LINES_SQL},
m AS (SELECT doc_id, ord, line, string_split(line, ',') AS p FROM lines),
i AS (SELECT *, coalesce(sum(CASE WHEN len(p) = 2 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS item FROM m),
o AS (SELECT doc_id, CAST(item AS BIGINT) AS item, md5(string_agg(chr(10) || CASE WHEN len(p) = 2 THEN p[1] ELSE line END, '' ORDER BY ord)) AS content, max(CASE WHEN len(p) = 2 THEN p[2] END) AS tags
FROM i GROUP BY doc_id, item HAVING bool_or(len(p) = 2)),
v AS (SELECT *, list_filter(list_transform(string_split(tags, ','), lambda x: replace(trim(x), '.', '_')), lambda x: x <> '') AS vs FROM o)
SELECT doc_id, item, content, array_to_string(vs, ',') AS tags FROM v
""",
)
def c16_tag_pairs(spark, folder):
    return tables.tag_pairs(comma_lines(spark, folder)).withColumns(
        {"content": F.md5("content"), "tags": F.array_join("tags", ",")}
    )


@query(
    "c17_table_rows_to_chunks",
    """
SELECT '- p_name: ' || p_name || chr(10) || '- p_brand: ' || p_brand || chr(10) || '- p_size: ' || p_size AS content, p_name, p_type, CAST(p_size AS BIGINT) AS p_size FROM part
""",
)
def c17_table_rows_to_chunks(spark, folder):
    rows = table(spark, folder, "part").select(F.col("p_partkey").alias("id"), "p_name", "p_brand", "p_type", "p_size")
    return tables.table_rows_to_chunks(rows, {"p_brand": "indexing", "p_type": "metadata"})


@query(
    "c18_infer_column_types",
    r"""
WITH u AS (UNPIVOT (SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_totalprice AS VARCHAR) AS o_totalprice, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
    CASE WHEN o_custkey % 2 = 0 THEN 'yes' ELSE 'No' END AS flag FROM orders) ON COLUMNS(*) INTO NAME "column" VALUE value),
k AS (SELECT "column", CASE WHEN regexp_matches(value, '^[+-]?[0-9]+$') AND NOT starts_with(value, '0') THEN 'int'
  WHEN regexp_matches(value, '^[+-]?[0-9.]{0,19}$') AND NOT starts_with(value, '0') THEN 'float'
  WHEN regexp_matches(lower(value), '^(true|yes|false|no)$') THEN 'bool'
  WHEN regexp_matches(value, '\d{4}-\d{1,2}') AND try_cast(value AS TIMESTAMP) IS NOT NULL THEN 'datetime' ELSE 'text' END AS type FROM u)
SELECT "column", arg_max(type, n) AS type FROM (SELECT "column", type, count(*) AS n FROM k GROUP BY ALL) GROUP BY "column"
""",
)
def c18_infer_column_types(spark, folder):
    return tables.infer_column_types(order_cells(spark, folder))


def order_cells(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        "o_totalprice",
        "o_orderstatus",
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"),
        F.when(F.col("o_custkey") % 2 == 0, "yes").otherwise("No").alias("flag"),
    )


@query(
    "c18_cast_columns",
    """
SELECT o_orderkey, o_totalprice, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, CASE WHEN o_custkey % 2 = 0 THEN 'yes' ELSE 'no' END AS flag FROM orders
""",
)
def c18_cast_columns(spark, folder):
    kinds = {"o_orderkey": "int", "o_totalprice": "float", "o_orderstatus": "text", "o_orderdate": "datetime", "flag": "bool"}
    return tables.cast_columns(order_cells(spark, folder), kinds)


@query(
    "c20_position_columns",
    f"""
WITH {inp.CHUNKS_SQL}
SELECT chunk_id, CAST(ord // 10 + 1 AS BIGINT) AS page, (ord // 10 + 1) || ',' || (ord % 5) || ',' || (ord % 5 + 50) || ',' || (ord % 100) || ',' || (ord % 100 + 10) AS pos, CAST(ord % 100 AS BIGINT) AS top_edge FROM chunks
""",
)
def c20_position_columns(spark, folder):
    ord_ = F.col("ord")
    box = F.struct(
        F.floor(ord_ / 10).alias("page"), (ord_ % 5).alias("left"), (ord_ % 5 + 50).alias("right"), (ord_ % 100).alias("top"), (ord_ % 100 + 10).alias("bottom")
    )
    placed = tables.position_columns(inp.chunks(spark, folder).select("chunk_id", F.array(box).alias("boxes")))
    return placed.select(
        "chunk_id", F.col("page_no")[0].alias("page"), F.array_join(F.col("pos")[0].cast("array<string>"), ",").alias("pos"), F.col("top_edge")[0].alias("top_edge")
    )


@query(
    "c21_index_columns",
    rf"""
WITH {inp.CHUNKS_SQL}, s AS (SELECT *, CASE WHEN ord % 2 = 0 THEN source || ' summary' ELSE content END AS body FROM chunks)
SELECT chunk_id, array_to_string({inp.sql_words('body')}, ' ') AS tokens, source AS title_tokens, lang || ' ' || source AS important_tokens, CAST(1 AS BIGINT) AS questions FROM s
""",
)
def c21_index_columns(spark, folder):
    chunks = inp.chunks(spark, folder).select(
        "chunk_id",
        "content",
        F.concat("source", F.lit(".txt")).alias("title"),
        F.when(F.col("ord") % 2 == 0, F.concat("source", F.lit(" summary"))).otherwise("").alias("summary"),
        F.concat(F.lit("What is "), "source", F.lit("?\n")).alias("questions"),
        F.concat_ws(",", "lang", "source").alias("keywords"),
    )
    return tables.index_columns(chunks).select(
        "chunk_id",
        F.array_join("tokens", " ").alias("tokens"),
        F.array_join("title_tokens", " ").alias("title_tokens"),
        F.array_join("important_tokens", " ").alias("important_tokens"),
        F.size("question_list").alias("questions"),
    )


@query(
    "c22_batch_table_rows",
    """
SELECT CAST((row_number() OVER (ORDER BY event_id) - 1) // 10 AS BIGINT) AS chunk, event_type || '=' || event_id AS s FROM events
""".strip().replace("SELECT CAST", "WITH r AS (SELECT CAST").replace("FROM events", "FROM events) SELECT chunk, string_agg(s, '; ' ORDER BY CAST(split_part(s, '=', 2) AS BIGINT)) AS content FROM r GROUP BY chunk"),
)
def c22_batch_table_rows(spark, folder):
    rows = table(spark, folder, "events").select(
        "event_id", F.concat("event_type", F.lit("="), F.col("event_id").cast("string")).alias("line")
    )
    return tables.batch_table_rows(rows, "event_id", "line", 10)


@query(
    "w6_pack_batches",
    f"""
WITH RECURSIVE {inp.LINES_SQL}, t AS (SELECT doc_id, ord, {inp.sql_token_count('line')} AS n FROM lines),
g AS (SELECT doc_id, ord, 0 AS grp, n AS tot FROM t WHERE ord = 0
  UNION ALL SELECT t.doc_id, t.ord, CASE WHEN g.tot + t.n > 200 THEN grp + 1 ELSE grp END, CASE WHEN g.tot + t.n > 200 THEN t.n ELSE g.tot + t.n END
  FROM g JOIN t ON t.doc_id = g.doc_id AND t.ord = g.ord + 1)
SELECT doc_id, CAST(grp AS BIGINT) AS batch, count(*) AS items, CAST(sum(t.n) AS BIGINT) AS tokens FROM g JOIN t USING (doc_id, ord) GROUP BY doc_id, grp
""",
)
def w6_pack_batches(spark, folder):
    counts = F.transform(F.split("text", "\n"), lambda s: F.regexp_count(s, F.lit(tx.TOKEN)))
    packed = documents(spark, folder).select("doc_id", counts.alias("n")).withColumn("batch", chunking.pack_groups(F.col("n"), 200))
    rows = packed.select("doc_id", F.explode(F.arrays_zip("batch", "n")).alias("e")).select("doc_id", "e.*")
    return rows.groupBy("doc_id", "batch").agg(F.count(F.lit(1)).alias("items"), F.sum("n").alias("tokens"))


@query("w7_media_context")
def w7_media_context(spark, folder):
    return chunking.media_context(typed_items(spark, folder), 32).filter("kind = 'table'").select(
        "doc_id", "pos", F.md5(F.concat("above", "text", "below")).alias("content")
    )
