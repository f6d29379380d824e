"""Scalar functions (X ids) over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import scalars as sc
from corvane.functions import text as tx
from corvane.plans import inputs as inp
from corvane.plans.registry import query, table

ENGLISH_SQL = r"""len(regexp_extract_all({0}, '[`a-zA-Z0-9.,'':;/"?<>!()\-]')) / CAST(length({0}) AS DOUBLE) > 0.8"""


@query(
    "x1_split",
    r"""
SELECT doc_id, CAST(len(a) AS BIGINT) AS n_dropped, md5(array_to_string(a, '|')) AS dropped,
       CAST(len(k) AS BIGINT) AS n_kept, md5(array_to_string(k, '|')) AS kept
FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '[.\n]'), lambda x: regexp_matches(x, '\S')) AS a,
             list_filter(regexp_extract_all(text, '[^.;]*[.;]|[^.;]+'), lambda x: regexp_matches(x, '\S')) AS k
      FROM documents)
""",
)
def x1_split(spark, folder):
    dropped, kept = tx.split_on("text", [".", "\n"]), tx.split_keep("text", [".", ";"])
    return table(spark, folder, "documents").select(
        "doc_id",
        F.size(dropped).alias("n_dropped"),
        F.md5(F.array_join(dropped, "|")).alias("dropped"),
        F.size(kept).alias("n_kept"),
        F.md5(F.array_join(kept, "|")).alias("kept"),
    )


@query(
    "x2_render",
    """
SELECT doc_id, 'Document ' || doc_id || ' (' || lang || ') from ' || source || ': ' || n_chars || ' characters' AS line
FROM documents
""",
)
def x2_render(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id",
        tx.render(
            "Document {id} ({lang}) from {source}: {n} characters",
            {"id": F.col("doc_id"), "lang": F.col("lang"), "source": F.col("source"), "n": F.col("n_chars")},
        ).alias("line"),
    )


@query(
    "x3_strip_table_tags",
    r"""
SELECT page_id, md5(regexp_replace('<table class="a"><tr><td>' || html || '</td></tr></table>',
       '</?(table|td|caption|tr|th)( [^<>]{0,12})?>', ' ', 'g')) AS clean
FROM pages
""",
)
def x3_strip_table_tags(spark, folder):
    wrapped = F.concat(F.lit('<table class="a"><tr><td>'), F.col("html"), F.lit("</td></tr></table>"))
    return table(spark, folder, "pages").select("page_id", F.md5(tx.strip_table_tags(wrapped)).alias("clean"))


@query(
    "x4_embed_text",
    r"""
SELECT event_id, CASE WHEN value > 100 THEN event_type || chr(10) || props
                      WHEN event_type = 'view' THEN 'None' ELSE ' ' || props || ' ' END AS body,
       CASE WHEN event_type = 'click' THEN 'Title' ELSE event_type END AS title
FROM events
""",
)
def x4_embed_text(spark, folder):
    events = table(spark, folder, "events")
    asked = F.when(F.col("value") > 100, F.array("event_type", "props")).otherwise(F.array().cast("array<string>"))
    content = F.when(F.col("event_type") == "view", "<tr> </tr>").otherwise(
        F.concat(F.lit("<td>"), F.col("props"), F.lit("</td>"))
    )
    title = F.when(F.col("event_type") != "click", F.col("event_type"))
    return events.select("event_id", tx.embed_text(asked, content).alias("body"), tx.embed_title(title).alias("title"))


@query(
    "x5_remove_redundant_spaces",
    r"""
SELECT doc_id, md5(regexp_replace(regexp_replace(text, '([^a-z0-9.,\)>]) +([^ ])', '\1\2', 'gi'),
       '([^ ]) +([^a-z0-9.,\(<])', '\1\2', 'gi')) AS clean
FROM documents
""",
)
def x5_remove_redundant_spaces(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.md5(tx.remove_redundant_spaces("text")).alias("clean"))


@query(
    "x6_clean_name",
    r"""
SELECT page_id, regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(trim(t),
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', chr(160)), '&middot;', '·'), '&copy;', '©'),
    '&amp;', '&'), '["\x00-\x1f\x7f-\x9f]', '', 'g') AS name
FROM (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS t FROM pages)
""",
)
def x6_clean_name(spark, folder):
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return table(spark, folder, "pages").select("page_id", tx.clean_name(title).alias("name"))


NORMALIZED_SQL = r"""regexp_replace(regexp_replace(regexp_replace(
    trim(regexp_replace(lower({0}), '[ :|\r\n\t,，。？?/`!！&^%()\[\]{{}}<>*~''"\\]+', ' ', 'g')),
    '是*(怎么办|什么样的|哪家|一下|那家|请问|啥样|咋样了|什么时候|何时|何地|何人|是否|是不是|多少|哪里|怎么|哪儿|怎么样|如何|哪些|是啥|啥是|啊|吗|呢|吧|咋|什么|有没有|呀|谁|哪位|哪个)是*', '', 'g'),
    '(^| )(what|who|how|which|where|why)(''re|''s)? ', ' ', 'gi'),
    '(^| )(''s|''re|is|are|were|was|do|does|did|don''t|doesn''t|didn''t|has|have|be|there|you|me|your|my|mine|just|please|may|i|should|would|wouldn''t|will|won''t|done|go|for|with|so|the|a|an|by|i''m|it''s|he''s|she''s|they|they''re|you''re|as|on|in|at|up|out|down|of|to|or|and|if) ', ' ', 'gi')"""


@query(
    "x7_normalize_query",
    "SELECT item_id AS query_id, n AS question FROM (SELECT item_id, "
    + NORMALIZED_SQL.format("text")
    + " AS n FROM benchmark)",
)
def x7_normalize_query(spark, folder):
    return inp.questions(spark, folder).select("query_id", tx.normalize_query("text").alias("question"))


@query(
    "x8_space_between_scripts",
    r"""
SELECT doc_id, lang || ' 文档 ' || source || ' 来源 ' || lang AS label FROM documents
""",
)
def x8_space_between_scripts(spark, folder):
    mixed = F.concat(F.col("lang"), F.lit("文档"), F.col("source"), F.lit("来源"), F.col("lang"))
    return table(spark, folder, "documents").select("doc_id", tx.space_between_scripts(mixed).alias("label"))


@query("x9_is_english", f"SELECT doc_id, {ENGLISH_SQL.format('text')} AS english FROM documents")
def x9_is_english(spark, folder):
    return table(spark, folder, "documents").select("doc_id", tx.is_english("text").alias("english"))


@query(
    "x10_is_cjk",
    r"""
SELECT item_id AS query_id,
       len(regexp_extract_all(text, '[\x{4e00}-\x{9fff}]')) / CAST(length(text) AS DOUBLE) > 0.2 AS cjk,
       len(p) <= 3 OR len(list_filter(p, lambda x: NOT regexp_matches(x, '^[a-zA-Z]+$'))) / CAST(len(p) AS DOUBLE) >= 0.7 AS cjk_form
FROM (SELECT item_id, text, regexp_split_to_array(text, '[ \t]+') AS p FROM benchmark)
""",
)
def x10_is_cjk(spark, folder):
    return inp.questions(spark, folder).select(
        "query_id", tx.is_cjk("text").alias("cjk"), tx.is_cjk_query("text").alias("cjk_form")
    )


@query(
    "x11_strip_qa_prefix",
    r"""
SELECT conv_id, turn, role IN ('user', 'assistant') AS marked,
       CASE WHEN role IN ('user', 'assistant') THEN md5(regexp_replace(trim(text), '^[\t:： ]+', ''))
            ELSE md5(trim(role || ': ' || text)) END AS body
FROM conversations
""",
)
def x11_strip_qa_prefix(spark, folder):
    line = F.concat(F.col("role"), F.lit(": "), F.col("text"))
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", tx.has_qa_prefix(line).alias("marked"), F.md5(tx.strip_qa_prefix(line)).alias("body")
    )


@query(
    "x12_arabic_forms",
    r"""
SELECT event_id, CAST(event_id AS VARCHAR) AS digits, replace(event_type, 'e', chr(1575)) AS name FROM events
""",
)
def x12_arabic_forms(spark, folder):
    arabic = F.translate(F.col("event_id").cast("string"), "0123456789", "٠١٢٣٤٥٦٧٨٩")
    presented = F.translate("event_type", "e", "ﺍ")
    return table(spark, folder, "events").select(
        "event_id", tx.arabic_digits(arabic).alias("digits"), tx.compatibility_form(presented).alias("name")
    )


@query(
    "x13_split_values",
    """
SELECT doc_id, CASE WHEN lang = 'en' THEN 'en,' || source ELSE lang || ',' || source || ',en' END AS parts FROM documents
""",
)
def x13_split_values(spark, folder):
    listed = F.concat(F.col("lang"), F.lit("; "), F.col("source"), F.lit(" ，|"), F.col("lang"), F.lit("、en"))
    return table(spark, folder, "documents").select(
        "doc_id", F.array_join(tx.split_values(listed), ",").alias("parts")
    )


@query(
    "x14_highlight",
    r"""
WITH flat AS (SELECT doc_id, regexp_replace(text, '[\r\n]', ' ', 'g') AS t FROM documents),
parts AS (
  SELECT doc_id, t, list_filter(list_transform(regexp_split_to_array(t, '[.?!;]'), lambda s: trim(s)), lambda s: s <> '') AS ss FROM flat),
marked AS (
  SELECT doc_id, t, list_filter(list_transform(ss, lambda s: CASE WHEN """
    + ENGLISH_SQL.format("s")
    + r"""
      THEN regexp_replace(regexp_replace(s, '(^|[ .?/''"\(\)!,:;-])(the)([ .?/''"\(\)!,:;-]|$)', '\1<em>\2</em>\3', 'gi'),
           '(^|[ .?/''"\(\)!,:;-])(les)([ .?/''"\(\)!,:;-]|$)', '\1<em>\2</em>\3', 'gi')
      ELSE regexp_replace(regexp_replace(s, 'the', '<em>the</em>', 'gi'), 'les', '<em>les</em>', 'gi') END),
      lambda s: regexp_matches(s, '<em>[^<>]+</em>')) AS hits FROM parts)
SELECT doc_id, md5(CASE WHEN len(hits) > 0 THEN array_to_string(hits, '...') ELSE t END) AS shown, CAST(len(hits) AS BIGINT) > 0 AS found
FROM marked
""",
)
def x14_highlight(spark, folder):
    shown = tx.highlight("text", ["the", "les"])
    return table(spark, folder, "documents").select(
        "doc_id", F.md5(shown).alias("shown"), shown.contains("<em>").alias("found")
    )


@query(
    "x15_time",
    r"""
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS parsed, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS seconds,
       strftime(ts, '%Y-%m-%d') AS day
FROM events
""",
)
def x15_time(spark, folder):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    stamp = sc.iso_to_timestamp(iso)
    return table(spark, folder, "events").select(
        "event_id",
        F.date_format(F.to_utc_timestamp(stamp, F.current_timezone()), "yyyy-MM-dd HH:mm:ss").alias("parsed"),
        F.unix_timestamp(stamp).alias("seconds"),
        F.date_format(F.to_date("ts"), "yyyy-MM-dd").alias("day"),
    )


@query(
    "x16_parse_datetime_any",
    r"""
SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT)
       - CASE event_type WHEN 'click' THEN 19800 WHEN 'view' THEN -10800 ELSE 0 END AS seconds
FROM events
""",
)
def x16_parse_datetime_any(spark, folder):
    zone = (
        F.when(F.col("event_type") == "click", "+0530")
        .when(F.col("event_type") == "view", "-3")
        .when(F.col("event_type") == "error", "+0000")
        .otherwise("Z")
    )
    spelled = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), zone)
    return table(spark, folder, "events").select(
        "event_id", F.unix_timestamp(sc.parse_datetime_any(spelled)).alias("seconds")
    )


@query(
    "x17_numbers",
    r"""
SELECT event_id, CASE WHEN event_type = 'click' THEN NULL ELSE value END AS number, event_type = 'click' AS invalid,
       CAST(CASE WHEN value < 1 THEN least(trunc(value * 100), 90) ELSE least(trunc(value), 90) END AS BIGINT) AS overlap
FROM events
""",
)
def x17_numbers(spark, folder):
    number = sc.get_float(F.when(F.col("event_type") == "click", "none").otherwise(F.col("value").cast("string")))
    return table(spark, folder, "events").select(
        "event_id",
        F.nullif(number, F.lit(float("-inf"))).alias("number"),
        (number == float("-inf")).alias("invalid"),
        sc.clamp_overlap(F.col("value")).alias("overlap"),
    )


def _next_vector(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    following = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("following"))
    return vectors.join(following, "vec_id")


@query(
    "x18_cosine",
    """
SELECT a.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS cosine
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1
""",
)
def x18_cosine(spark, folder):
    return _next_vector(spark, folder).select("vec_id", sc.cosine(F.col("embedding"), F.col("following")).alias("cosine"))


@query(
    "x19_blend_vectors",
    """
SELECT a.vec_id, round(0.1 * list_extract(CAST(a.embedding AS DOUBLE[]), 1) + 0.9 * list_extract(CAST(b.embedding AS DOUBLE[]), 1), 6) AS first_element,
       round(0.1 * list_sum(CAST(a.embedding AS DOUBLE[])) + 0.9 * list_sum(CAST(b.embedding AS DOUBLE[])), 6) AS total
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1
""",
)
def x19_blend_vectors(spark, folder):
    mixed = sc.blend_vectors(F.col("embedding"), F.col("following"))
    return _next_vector(spark, folder).select(
        "vec_id",
        F.element_at(mixed, 1).alias("first_element"),
        F.aggregate(mixed, F.lit(0.0), lambda s, x: s + x).alias("total"),
    )


@query(
    "x20_parse_tag_features",
    """
SELECT event_id, event_type AS tags, value AS score FROM events
""",
)
def x20_parse_tag_features(spark, folder):
    raw = F.concat(
        F.lit('{"'), F.col("event_type"), F.lit('": '), F.col("value"), F.lit(', "word": "x", "digits": "5", "flag": true, " ": 3}')
    )
    features = sc.parse_tag_features(raw)
    return table(spark, folder, "events").select(
        "event_id",
        F.array_join(F.map_keys(features), ",").alias("tags"),
        F.element_at(F.map_values(features), 1).alias("score"),
    )


@query(
    "x21_literal_value",
    """
SELECT event_id, CAST(json(props) AS VARCHAR) AS nested, '"' || event_type || '"' AS word FROM events
""",
)
def x21_literal_value(spark, folder):
    return table(spark, folder, "events").select(
        "event_id",
        F.to_json(sc.literal_value(F.col("props"))).alias("nested"),
        F.to_json(F.try_variant_get(sc.literal_value(F.col("event_type")), "$[0]", "variant")).alias("word"),
    )


@query(
    "x22_record_value",
    """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS missing FROM events
""",
)
def x22_record_value(spark, folder):
    return table(spark, folder, "events").select(
        "event_id",
        sc.record_value(F.col("props"), "k", "bigint").alias("k"),
        sc.record_value(F.col("props"), "k.inner").alias("missing"),
    )


@query("x23_stable_id", "SELECT doc_id, md5(text || chr(1) || CAST(doc_id AS VARCHAR)) AS chunk_id FROM documents")
def x23_stable_id(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", tx.stable_id(F.col("text"), F.col("doc_id")).alias("chunk_id")
    )


@query(
    "x25_tokens",
    f"""
SELECT doc_id, CAST({inp.sql_token_count('text')} AS BIGINT) AS n_tokens,
       array_to_string(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_\\s]')[1:20], ' ') AS head
FROM documents
""",
)
def x25_tokens(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", tx.token_count("text").alias("n_tokens"), tx.truncate_tokens("text", 20).alias("head")
    )


@query(
    "x26_typed_cell",
    """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS as_int, value AS as_float,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS as_datetime,
       CASE event_type WHEN 'click' THEN 'yes' WHEN 'view' THEN 'no' END AS as_bool, event_type AS as_text
FROM events
""",
)
def x26_typed_cell(spark, folder):
    word = F.when(F.col("event_type") == "click", "YES").when(F.col("event_type") == "view", "false").otherwise("maybe")
    return table(spark, folder, "events").select(
        "event_id",
        sc.typed_cell(F.get_json_object("props", "$.k"), "int").alias("as_int"),
        sc.typed_cell(F.col("value"), "float").alias("as_float"),
        sc.typed_cell(F.col("ts"), "datetime").alias("as_datetime"),
        sc.typed_cell(word, "bool").alias("as_bool"),
        sc.typed_cell(F.col("event_type"), "text").alias("as_text"),
    )
