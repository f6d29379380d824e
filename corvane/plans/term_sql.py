"""SQL fragments that the twins of the text and retrieval queries share."""

from __future__ import annotations

from corvane.plans import inputs as inp
from corvane.plans.scalar_queries import NORMALIZED_SQL

STATS_SQL = f"""stats AS (
  SELECT token, count(DISTINCT doc_id) AS df, count(*) AS tf
  FROM (SELECT doc_id, unnest({inp.sql_words('text')}) AS token FROM documents) GROUP BY token)"""

RAW_WEIGHT_SQL = r"""(0.3 * log10(10 + (10000000 - freq + 0.5) / (freq + 0.5)) + 0.7 * log10(10 + (1000000000 - docs + 0.5) / (docs + 0.5)))
  * (CASE WHEN regexp_matches(token, '^[0-9,.]{2,}$') THEN 2 WHEN regexp_matches(token, '^[a-z]{1,2}$') THEN 0.01 ELSE 1 END)
  * (CASE WHEN regexp_matches(token, '^[0-9-]') THEN 2 ELSE 1 END)"""

COUNTS_SQL = r"""CAST(CASE WHEN regexp_matches(token, '^[0-9. -]{2,}$') THEN 3
       ELSE greatest(coalesce(tf, CASE WHEN regexp_matches(token, '^[a-z. -]+$') THEN 300 END, 10), 10) END AS DOUBLE) AS freq,
  CAST(CASE WHEN regexp_matches(token, '^[0-9. -]{2,}$') THEN 5
       ELSE coalesce(df + 3, CASE WHEN regexp_matches(token, '^[a-z. -]+$') THEN 300 END, 3) END AS DOUBLE) AS docs"""

QUERY_WEIGHTS_SQL = f"""qwords AS (
  SELECT item_id AS query_id, {inp.sql_words('(' + NORMALIZED_SQL.format('text') + ')')} AS w FROM benchmark),
qtok AS (SELECT query_id, unnest(w) AS token, generate_subscripts(w, 1) - 1 AS pos FROM qwords),
qraw AS (SELECT query_id, pos, token, {RAW_WEIGHT_SQL} AS raw
  FROM (SELECT query_id, pos, token, {COUNTS_SQL} FROM qtok LEFT JOIN stats USING (token))),
qw AS (SELECT query_id, pos, token, raw / sum(raw) OVER (PARTITION BY query_id) AS weight FROM qraw),
qterms AS (SELECT query_id, token AS term, sum(weight) AS weight FROM qw GROUP BY ALL)"""

CHUNK_TOKENS_SQL = f"""titles AS (SELECT doc_id, {inp.sql_words('string_split(text, chr(10))[1]')} AS title_tokens FROM documents),
ctok AS (SELECT chunk_id, c.doc_id, source || '/' || c.doc_id AS doc_name, {inp.sql_words('content')} AS tokens, title_tokens
  FROM chunks c JOIN titles USING (doc_id)),
post AS (
  SELECT chunk_id, term, count(*) FILTER (WHERE field = 'content') AS tf_content, count(*) FILTER (WHERE field = 'title') AS tf_title
  FROM (SELECT chunk_id, unnest(tokens) AS term, 'content' AS field FROM ctok
        UNION ALL SELECT chunk_id, unnest(title_tokens), 'title' FROM ctok) GROUP BY ALL),
lens AS (SELECT chunk_id, len(tokens) AS len_content, len(title_tokens) AS len_title FROM ctok),
fstat AS (SELECT count(*) FILTER (WHERE len_content > 0) AS n_content, sum(len_content) / count(*) FILTER (WHERE len_content > 0) AS avg_content,
  count(*) FILTER (WHERE len_title > 0) AS n_title, sum(len_title) / count(*) FILTER (WHERE len_title > 0) AS avg_title FROM lens),
tdf AS (SELECT term, count(*) FILTER (WHERE tf_content > 0) AS df_content, count(*) FILTER (WHERE tf_title > 0) AS df_title FROM post GROUP BY term),
qsize AS (SELECT query_id, count(*) AS n FROM qterms GROUP BY query_id)"""


def text_hits_sql(name: str, share: float, terms: str = "qterms", sizes: str = "qsize") -> str:
    return f"""{name} AS (
  SELECT query_id, chunk_id, greatest(s_content, s_title, 0) AS score, matched FROM (
    SELECT q.query_id, p.chunk_id, count(*) AS matched, max(n) AS n,
      sum(CASE WHEN tf_content > 0 THEN weight * 2 * ln(1 + (n_content - df_content + 0.5) / (df_content + 0.5))
          * tf_content * 2.2 / (tf_content + 1.2 * (0.25 + 0.75 * len_content / avg_content)) ELSE 0 END) AS s_content,
      sum(CASE WHEN tf_title > 0 THEN weight * 10 * ln(1 + (n_title - df_title + 0.5) / (df_title + 0.5))
          * tf_title * 2.2 / (tf_title + 1.2 * (0.25 + 0.75 * len_title / avg_title)) ELSE 0 END) AS s_title
    FROM {terms} q JOIN post p USING (term) JOIN tdf USING (term) JOIN lens l ON l.chunk_id = p.chunk_id
         JOIN {sizes} z ON z.query_id = q.query_id CROSS JOIN fstat
    GROUP BY q.query_id, p.chunk_id) WHERE matched >= greatest(1, floor(n * {share})))"""


CENTROID_SQL = """cen AS (
  SELECT label, list(v ORDER BY pos) AS vector FROM (
    SELECT label, pos, avg(v) AS v FROM (
      SELECT label, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings)
    GROUP BY label, pos) GROUP BY label),
qvec AS (SELECT item_id AS query_id, vector FROM benchmark JOIN cen ON label = item_id % 10),
cvec AS (SELECT chunk_id, CAST(embedding AS DOUBLE[]) AS embedding FROM chunks JOIN embeddings ON vec_id = doc_id)"""

RETRIEVAL_BASE = (
    "WITH " + inp.CHUNKS_SQL + ",\n" + STATS_SQL + ",\n" + QUERY_WEIGHTS_SQL + ",\n" + CHUNK_TOKENS_SQL
)

FEATURES_SQL = """qfeat AS (
  SELECT query_id, feature, sum(weight) AS weight FROM (
    SELECT query_id, token AS feature, weight * 0.4 AS weight FROM qw
    UNION ALL
    SELECT a.query_id, a.token || b.token, greatest(a.weight, b.weight) * 0.6
    FROM qw a JOIN qw b ON a.query_id = b.query_id AND b.pos = a.pos + 1) GROUP BY ALL),
ftotal AS (SELECT query_id, sum(weight) AS total FROM qfeat GROUP BY query_id)"""


def bag_sql(name: str, hits: str, title: bool = True) -> str:
    """Features of the bags of the chunks in ``hits``: distinct content then the title twice, and adjacent pairs."""
    title_part = "title_tokens || title_tokens" if title else "[]::VARCHAR[]"
    distinct = "list_filter(tokens, lambda x, i: list_position(tokens, x) = i)"
    return f"""{name}_seq AS (
  SELECT chunk_id, {distinct} || {title_part} AS bag FROM ctok SEMI JOIN {hits} USING (chunk_id)),
{name} AS (
  SELECT DISTINCT chunk_id, feature FROM (
    SELECT chunk_id, unnest(bag) AS feature FROM {name}_seq
    UNION ALL
    SELECT chunk_id, unnest(list_transform(bag[1:-2], lambda x, i: x || bag[i + 1])) FROM {name}_seq WHERE len(bag) > 1))"""
