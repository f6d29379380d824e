"""Vector and hybrid retrieval (R ids), fusion and hit post-processing (J, L, W ids on hits)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import scalars as sc
from corvane.functions import text as tx
from corvane.operators import aggregates, filters, joins, ordering, postings, retrieval, terms, vector_cells
from corvane.plans import inputs as inp
from corvane.plans.registry import TWINS, query, table
from corvane.plans.term_sql import CENTROID_SQL, FEATURES_SQL, RETRIEVAL_BASE, bag_sql, text_hits_sql
from corvane.session import cut_lineage
from corvane.plans.text_queries import (
    BOOSTS,
    indexed_chunks,
    chunk_index,
    question_terms,
    text_base,
    text_hits,
)


def centroids(spark, folder):
    """Mean vector of each label."""
    parts = table(spark, folder, "embeddings").select("label", F.posexplode("embedding").alias("pos", "v"))
    means = parts.groupBy("label", "pos").agg(F.avg(F.col("v").cast("double")).alias("v"))
    return means.groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "v"))), lambda e: e["v"]).alias("vector")
    )


def question_vectors(spark, folder):
    """Each question asks with the mean vector of one label."""
    return (
        inp.questions(spark, folder)
        .select("query_id", (F.col("query_id") % 10).cast("int").alias("label"))
        .join(centroids(spark, folder), "label")
        .select("query_id", "vector")
    )


def chunk_vectors(spark, folder):
    """A chunk takes its document's vector, where there is one."""
    vectors = table(spark, folder, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    return inp.chunks(spark, folder).select("chunk_id", "doc_id").join(vectors, "doc_id").select("chunk_id", "embedding")


def label_queries(spark, folder):
    return centroids(spark, folder).select(F.col("label").alias("query_id"), "vector")


def item_vectors(spark, folder):
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("chunk_id"), "embedding")


VECTOR_HITS_SQL = f"""
WITH {inp.CHUNKS_SQL}, {CENTROID_SQL},
sims AS (SELECT label AS query_id, vec_id AS chunk_id,
    round(list_cosine_similarity(vector, CAST(embedding AS DOUBLE[])), 6) AS score FROM cen CROSS JOIN (SELECT vec_id, embedding FROM embeddings) e),
vhits AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM sims WHERE score >= 0.1)
"""


@query("r2_vector_match", VECTOR_HITS_SQL + "SELECT CAST(query_id AS BIGINT) AS query_id, chunk_id, score, rank FROM vhits WHERE rank <= 20")
def r2_vector_match(spark, folder):
    return retrieval.vector_match(label_queries(spark, folder), item_vectors(spark, folder), 20, 0.1)


@query("r3_vector_match_approx")
def r3_vector_match_approx(spark, folder):
    """Recall against the exact result, per query."""
    queries, vectors = label_queries(spark, folder), item_vectors(spark, folder)
    exact = retrieval.vector_match(queries, vectors, 10).select("query_id", "chunk_id")
    near = retrieval.vector_match_approx(queries, vectors, 10).select("query_id", "chunk_id", F.lit(1).alias("found"))
    return (
        exact.join(near, ["query_id", "chunk_id"], "left")
        .groupBy("query_id")
        .agg((F.count("found") / F.count(F.lit(1))).alias("recall"))
    )


FIRST_STAGE_SQL = f"""{RETRIEVAL_BASE},
{CENTROID_SQL},
{FEATURES_SQL},
{text_hits_sql('strict', 0.3)},
sblend AS (
  SELECT query_id, chunk_id, coalesce(list_cosine_similarity(vector, embedding), 0) AS cosine, score AS text_score
  FROM strict LEFT JOIN qvec USING (query_id) LEFT JOIN cvec USING (chunk_id)),
sranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM (
    SELECT query_id, chunk_id, cosine,
      round(text_score * 0.05 + CASE WHEN round(cosine, 6) >= 0.1 THEN cosine ELSE 0 END * 0.95, 6) AS score FROM sblend)),
missed AS (SELECT query_id, term, weight FROM qterms ANTI JOIN strict USING (query_id)),
{text_hits_sql('relaxed', 0.1, terms='missed')},
rblend AS (
  SELECT query_id, chunk_id, coalesce(list_cosine_similarity(vector, embedding), 0) AS cosine, score AS text_score
  FROM relaxed LEFT JOIN qvec USING (query_id) LEFT JOIN cvec USING (chunk_id)),
rranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM (
    SELECT query_id, chunk_id, cosine,
      round(text_score * 0.05 + CASE WHEN round(cosine, 6) >= 0.17 THEN cosine ELSE 0 END * 0.95, 6) AS score FROM rblend)),
found AS (SELECT * FROM sranked WHERE rank <= 1024 UNION ALL SELECT * FROM rranked WHERE rank <= 1024)"""


def first_stage(spark, folder, base, topn=1024):
    chunks, weights = base
    asked = question_terms(weights)
    return retrieval.search(
        asked, question_vectors(spark, folder), chunk_index(spark, folder), chunk_vectors(spark, folder), BOOSTS, topn
    )


@query("r10_search", FIRST_STAGE_SQL + "\nSELECT query_id, chunk_id, score, round(cosine, 6) AS cosine, rank FROM found")
def r10_search(spark, folder):
    return first_stage(spark, folder, text_base(spark, folder))


RERANKED_SQL = f"""{FIRST_STAGE_SQL},
win AS (SELECT query_id, chunk_id, cosine FROM found WHERE rank <= 70),
{bag_sql('bagf', 'win')},
cov AS (SELECT w.query_id, w.chunk_id, sum(f.weight) AS covered
  FROM win w JOIN bagf b ON b.chunk_id = w.chunk_id JOIN qfeat f ON f.query_id = w.query_id AND f.feature = b.feature GROUP BY ALL),
sim AS (SELECT w.query_id, w.chunk_id, c.doc_id, c.doc_name, w.cosine,
  (coalesce(covered, 0) + 1e-9) / (total + 1e-9) AS token_sim, sum(w.cosine) OVER (PARTITION BY w.query_id) AS cosines
  FROM win w JOIN ctok c USING (chunk_id) JOIN ftotal USING (query_id) LEFT JOIN cov USING (query_id, chunk_id)),
blend AS (SELECT *, CASE WHEN round(cosines, 9) = 0 THEN token_sim ELSE 0.7 * token_sim + 0.3 * cosine END AS hybrid FROM sim),
valid AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, chunk_id) AS rank FROM (
  SELECT *, round(hybrid, 6) AS similarity FROM blend) WHERE similarity >= 0.2)"""


def ranked_page(spark, folder):
    base = text_base(spark, folder)
    return retrieval.retrieval(
        first_stage(spark, folder, base),
        base[0],
        table(spark, folder, "documents").select("doc_id"),
        retrieval.query_features(base[1]),
    )


@query(
    "r11_retrieval",
    RERANKED_SQL
    + """
SELECT query_id, rank, chunk_id, doc_id, doc_name, similarity, round(token_sim, 6) AS token_sim, round(cosine, 6) AS cosine,
       count(*) OVER (PARTITION BY query_id) AS total FROM valid QUALIFY rank <= 10
""",
)
def r11_retrieval(spark, folder):
    rows, _ = ranked_page(spark, folder)
    return rows.select("query_id", "rank", "chunk_id", "doc_id", "doc_name", "similarity", "token_sim", "cosine", "total")


@query(
    "a2_doc_aggs",
    RERANKED_SQL + "\nSELECT query_id, doc_name, count(*) AS n, arg_min(doc_id, rank) AS doc_id FROM valid GROUP BY query_id, doc_name",
)
def a2_doc_aggs(spark, folder):
    _, facets = ranked_page(spark, folder)
    return facets


TEXT_HITS_SQL = f"{RETRIEVAL_BASE},\n{text_hits_sql('hits', 0.3)}"


@query(
    "w1_rank_hits",
    TEXT_HITS_SQL + "\nSELECT query_id, chunk_id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, chunk_id) AS rank FROM hits",
)
def w1_rank_hits(spark, folder):
    return ordering.rank_hits(text_hits(spark, folder).select("query_id", "chunk_id", "score"))


@query(
    "l5_topk_per_query",
    TEXT_HITS_SQL
    + "\nSELECT query_id, chunk_id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, chunk_id) AS rank FROM hits QUALIFY rank <= 5",
)
def l5_topk_per_query(spark, folder):
    return ordering.topk_per_query(text_hits(spark, folder).select("query_id", "chunk_id", "score"), 5)


FUSE_SQL = f"""{TEXT_HITS_SQL},
{CENTROID_SQL},
vsims AS (SELECT query_id, chunk_id, list_cosine_similarity(vector, embedding) AS score FROM qvec CROSS JOIN cvec),
vtop AS (SELECT * FROM vsims WHERE round(score, 6) >= 0.1 QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, chunk_id) <= 50)"""


def vector_hits(spark, folder):
    return retrieval.vector_match(question_vectors(spark, folder), chunk_vectors(spark, folder), 50, 0.1)


@query(
    "j1_fuse_scores",
    FUSE_SQL
    + """,
fused AS (
  SELECT query_id, chunk_id, coalesce(t.score, 0) AS text_score, coalesce(v.score, 0) AS vector_score,
         round(coalesce(t.score, 0) * 0.05 + coalesce(v.score, 0) * 0.95 + coalesce(quality, 0) / 100.0, 6) AS score
  FROM hits t FULL JOIN vtop v USING (query_id, chunk_id) JOIN chunks c USING (chunk_id) LEFT JOIN labels l ON l.doc_id = c.doc_id)
SELECT query_id, chunk_id, round(text_score, 6) AS text_score, round(vector_score, 6) AS vector_score, score,
       row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM fused QUALIFY rank <= 30
""",
)
def j1_fuse_scores(spark, folder):
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("pagerank"))
    pagerank = inp.chunks(spark, folder).select("chunk_id", "doc_id").join(labels, "doc_id")
    return retrieval.fuse_scores(
        text_hits(spark, folder), vector_hits(spark, folder), 0.05, 30, pagerank=pagerank
    )


@query(
    "j2_fuse_text_first",
    FUSE_SQL
    + """,
first AS (SELECT query_id, chunk_id, score AS text_score FROM hits
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, chunk_id) <= 200),
blended AS (
  SELECT query_id, chunk_id, text_score, coalesce(list_cosine_similarity(vector, embedding), 0) AS vector_score
  FROM first LEFT JOIN qvec USING (query_id) LEFT JOIN cvec USING (chunk_id))
SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM (
  SELECT query_id, chunk_id, round(text_score, 6) AS text_score, round(vector_score, 6) AS vector_score, round(text_score * 0.05 + vector_score * 0.95, 6) AS score
  FROM blended WHERE round(vector_score, 6) >= 0.05) QUALIFY rank <= 30
""",
)
def j2_fuse_text_first(spark, folder):
    return retrieval.fuse_text_first(
        text_hits(spark, folder), question_vectors(spark, folder), chunk_vectors(spark, folder), 0.05, 200, 0.05, 30
    )


@query(
    "r9_normalize_scores",
    TEXT_HITS_SQL
    + """
SELECT query_id, chunk_id, round(CASE WHEN hi > lo THEN (score - lo) / (hi - lo) ELSE 1 END, 6) AS by_range,
       round(atan(score) * 2 / pi(), 6) AS by_angle
FROM (SELECT *, min(score) OVER (PARTITION BY query_id) AS lo, max(score) OVER (PARTITION BY query_id) AS hi FROM hits)
""",
)
def r9_normalize_scores(spark, folder):
    ranged = retrieval.normalize_scores(text_hits(spark, folder)).withColumnRenamed("normalized", "by_range")
    return retrieval.normalize_scores(ranged, "atan").select(
        "query_id", "chunk_id", "by_range", F.col("normalized").alias("by_angle")
    )


WINDOW_HITS_SQL = f"""{RETRIEVAL_BASE},
{FEATURES_SQL},
{text_hits_sql('hits', 0.3)},
win AS (SELECT query_id, chunk_id, score FROM hits QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, chunk_id) <= 70)"""


def top_text_hits(spark, folder, k=70, base=None):
    """Best text hits, written, so that Spark knows how few they are before it joins them with all chunks."""
    return cut_lineage(ordering.topk_per_query(text_hits(spark, folder, base, k).select("query_id", "chunk_id", "score"), k))


@query(
    "r4_token_similarity",
    f"""{WINDOW_HITS_SQL},
{bag_sql('bagf', 'win', title=False)}
SELECT w.query_id, w.chunk_id, round((coalesce(sum(f.weight), 0) + 1e-9) / (max(total) + 1e-9), 6) AS token_sim
FROM win w JOIN ftotal t ON t.query_id = w.query_id JOIN bagf b ON b.chunk_id = w.chunk_id
LEFT JOIN qfeat f ON f.query_id = w.query_id AND f.feature = b.feature GROUP BY ALL
""",
)
def r4_token_similarity(spark, folder):
    chunks, weights = base = text_base(spark, folder)
    return (
        top_text_hits(spark, folder, base=base)
        .join(chunks.select("chunk_id", "tokens"), "chunk_id")
        .join(retrieval.query_features(weights), "query_id")
        .select(
            "query_id",
            "chunk_id",
            retrieval.token_similarity(
                F.col("features"), F.col("feature_total"), retrieval.bag_of(F.col("tokens"))
            ).alias("token_sim"),
        )
    )


@query(
    "r5_bag_of",
    f"""{RETRIEVAL_BASE}
SELECT chunk_id, array_to_string(list_filter(tokens, lambda x, i: list_position(tokens, x) = i) || title_tokens || title_tokens
  || [lang, lang, lang, lang, lang] || [source, source, source, source, source, source], ' ') AS bag
FROM ctok JOIN (SELECT chunk_id, lang, source FROM chunks) USING (chunk_id)
""",
)
def r5_bag_of(spark, folder):
    bag = retrieval.bag_of(
        F.col("tokens"), F.col("title_tokens"), F.array("lang"), F.array(F.split_part("doc_name", F.lit("/"), F.lit(1)))
    )
    tagged = indexed_chunks(spark, folder).join(
        table(spark, folder, "documents").select("doc_id", "lang"), "doc_id"
    )
    return tagged.select("chunk_id", F.array_join(bag, " ").alias("bag"))


@query(
    "r6_hybrid_score",
    f"""{WINDOW_HITS_SQL},
{CENTROID_SQL},
{bag_sql('bagf', 'win')},
cov AS (SELECT w.query_id, w.chunk_id, sum(f.weight) AS covered
  FROM win w JOIN bagf b ON b.chunk_id = w.chunk_id JOIN qfeat f ON f.query_id = w.query_id AND f.feature = b.feature GROUP BY ALL),
sim AS (SELECT query_id, chunk_id, (coalesce(covered, 0) + 1e-9) / (total + 1e-9) AS token_sim,
  coalesce(list_cosine_similarity(vector, embedding), 0) AS cosine
  FROM win JOIN ftotal USING (query_id) LEFT JOIN cov USING (query_id, chunk_id) LEFT JOIN qvec USING (query_id) LEFT JOIN cvec USING (chunk_id))
SELECT query_id, chunk_id, round(token_sim, 6) AS token_sim, round(cosine, 6) AS cosine,
  round(CASE WHEN round(sum(cosine) OVER (PARTITION BY query_id), 9) = 0 THEN token_sim ELSE 0.3 * token_sim + 0.7 * cosine END, 6) AS hybrid
FROM sim
""",
)
def r6_hybrid_score(spark, folder):
    chunks, weights = base = text_base(spark, folder)
    pairs = retrieval.pair_similarity(
        top_text_hits(spark, folder, base=base).select("query_id", "chunk_id"), question_vectors(spark, folder), chunk_vectors(spark, folder)
    )
    staged = (
        cut_lineage(pairs).join(chunks, "chunk_id")
        .join(retrieval.query_features(weights), "query_id")
        .withColumn(
            "token_sim",
            retrieval.token_similarity(
                F.col("features"), F.col("feature_total"), retrieval.bag_of(F.col("tokens"), F.col("title_tokens"))
            ),
        )
    )
    return retrieval.hybrid_score(staged).select("query_id", "chunk_id", "token_sim", "cosine", "hybrid")


RANK_FEATURE_SQL = """
SELECT event_id, round(CASE WHEN event_type = 'view' THEN k ELSE
  10 * (2.0 * value) / (sqrt(value * value + k * k) * sqrt(5.0)) + k END, 6) AS score
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)
"""


@query("r7_rank_feature_score", RANK_FEATURE_SQL)
def r7_rank_feature_score(spark, folder):
    k = F.get_json_object("props", "$.k").cast("double")
    asked = F.create_map(F.lit("value"), F.lit(2.0), F.lit("other"), F.lit(1.0))
    held = F.when(F.col("event_type") != "view", F.create_map(F.lit("value"), F.col("value"), F.lit("k"), k))
    return table(spark, folder, "events").select(
        "event_id", retrieval.rank_feature_score(asked, held, k).alias("score")
    )


@query(
    "r8_rerank",
    f"""{WINDOW_HITS_SQL},
{bag_sql('bagf', 'win')},
cov AS (SELECT w.query_id, w.chunk_id, sum(f.weight) AS covered
  FROM win w JOIN bagf b ON b.chunk_id = w.chunk_id JOIN qfeat f ON f.query_id = w.query_id AND f.feature = b.feature GROUP BY ALL)
SELECT query_id, chunk_id, round(0.3 * (coalesce(covered, 0) + 1e-9) / (total + 1e-9) + 0.7 * score / 100 + len(tokens) / 1000.0, 6) AS similarity
FROM win JOIN ftotal USING (query_id) JOIN ctok USING (chunk_id) LEFT JOIN cov USING (query_id, chunk_id)
""",
)
def r8_rerank(spark, folder):
    chunks, weights = base = text_base(spark, folder)
    external = top_text_hits(spark, folder, base=base).select("query_id", "chunk_id", (F.col("score") / 100).alias("model_score"))
    ranked = retrieval.rerank(
        external,
        chunks,
        retrieval.query_features(weights),
        0.3,
        0.7,
        rank_feature=F.size("tokens") / 1000.0,
        vector_score="model_score",
    )
    return ranked.select("query_id", "chunk_id", "similarity")


@query(
    "r12_filter_browse",
    f"""
WITH {inp.CHUNKS_SQL}
SELECT chunk_id, doc_id, ord, lang FROM chunks WHERE lang IN ('en', 'fr') ORDER BY ord DESC, doc_id LIMIT 30 OFFSET 60
""",
)
def r12_filter_browse(spark, folder):
    return retrieval.filter_browse(
        inp.chunks(spark, folder), {"lang": ["en", "fr"], "source": ""}, [("ord", "desc"), ("doc_id", "asc")], 3, 30
    ).select("chunk_id", "doc_id", "ord", "lang")


@query(
    "r16_message_search",
    rf"""
WITH {inp.MESSAGES_SQL},
live AS (SELECT message_id, {inp.sql_words('content')} AS w FROM messages WHERE forget_at IS NULL),
post AS (SELECT message_id, token AS term, count(*) AS tf FROM (SELECT message_id, unnest(w) AS token FROM live) GROUP BY ALL),
stats AS (SELECT term AS token, count(*) AS df, sum(tf) AS tf FROM post GROUP BY term),
qt AS (SELECT item_id AS query_id, unnest({inp.sql_words('text')}) AS token FROM benchmark),
qc AS (SELECT query_id, token AS term, count(*) AS c FROM qt GROUP BY query_id, token),
qn AS (SELECT query_id, term, c / CAST(sum(c) OVER (PARTITION BY query_id) AS DOUBLE) AS weight FROM qc),
size AS (SELECT query_id, count(*) AS n FROM qn GROUP BY query_id),
f AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS n_all, sum(len(w)) / count(*) FILTER (WHERE len(w) > 0) AS avg_all FROM live),
scored AS (
  SELECT q.query_id, p.message_id, count(*) AS matched, max(n) AS n,
    sum(weight * ln(1 + (n_all - df + 0.5) / (df + 0.5)) * p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * len(w) / avg_all))) AS s
  FROM qn q JOIN post p USING (term) JOIN stats ON stats.token = term JOIN live l ON l.message_id = p.message_id
       JOIN size z ON z.query_id = q.query_id CROSS JOIN f GROUP BY q.query_id, p.message_id)
SELECT query_id, message_id, round(s, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 6) DESC, message_id) AS rank
FROM scored WHERE matched >= greatest(1, floor(n * 0.3)) QUALIFY rank <= 10
""",
)
def r16_message_search(spark, folder):
    weights, index = asked_messages(spark, folder)
    hits = retrieval.text_match(weights, index, {"body": 1.0}, 0.3)
    return ordering.topk_per_query(hits.select("query_id", "chunk_id", "score"), 10).withColumnRenamed("chunk_id", "message_id")


def asked_messages(spark, folder):
    """The question set's terms by their share, and the index of all messages that are still valid."""
    live = filters.valid_messages(inp.messages(spark, folder).withColumn("status", F.lit(1)))
    corpus = live.select(F.col("message_id").alias("chunk_id"), tx.words("content").alias("tokens"))
    asked = inp.questions(spark, folder).select("query_id", F.explode(tx.words("text")).alias("term"))
    counts = asked.groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("c"))
    totals = asked.groupBy("query_id").agg(F.count(F.lit(1)).alias("total"))
    weights = counts.join(totals, "query_id").select("query_id", "term", (F.col("c") / F.col("total")).alias("weight"))
    return weights, postings.build(corpus, {"body": "tokens"})


MESSAGE_VECTORS_SQL = """qv AS (SELECT item_id AS query_id, vector FROM benchmark JOIN cen ON label = item_id % 10),
near AS (SELECT query_id, message_id, score FROM (
  SELECT query_id, message_id, list_cosine_similarity(vector, CAST(embedding AS DOUBLE[])) AS score,
    row_number() OVER (PARTITION BY query_id ORDER BY round(list_cosine_similarity(vector, CAST(embedding AS DOUBLE[])), 6) DESC, message_id) AS rank
  FROM qv, live JOIN messages m USING (message_id) JOIN embeddings ON vec_id = m.memory_id * 5 + m.turn WHERE round(list_cosine_similarity(vector, CAST(embedding AS DOUBLE[])), 6) >= 0.1) WHERE rank <= 10),
both_ AS (SELECT query_id, message_id, coalesce(t.s, 0) AS text_score, coalesce(n.score, 0) AS vector_score
  FROM (SELECT query_id, message_id, s FROM scored WHERE matched >= greatest(1, floor(n * 0.3))) t FULL JOIN near n USING (query_id, message_id))
SELECT query_id, message_id, round(text_score * 0.7 + vector_score * 0.3, 6) AS score,
  row_number() OVER (PARTITION BY query_id ORDER BY round(text_score * 0.7 + vector_score * 0.3, 6) DESC, message_id) AS rank
FROM both_ QUALIFY rank <= 10"""
_MESSAGES_TEXT_SQL = TWINS["r16_message_search"]


@query("r16_message_hybrid", _MESSAGES_TEXT_SQL[: _MESSAGES_TEXT_SQL.rindex("SELECT query_id, message_id, round(s, 6)")].rstrip() + f",\n{CENTROID_SQL.split('qvec AS')[0].rstrip().rstrip(',')},\n{MESSAGE_VECTORS_SQL}")
def r16_message_hybrid(spark, folder):
    """Words at 0.7 and vectors at the rest; a message's vector is the one of its memory and turn."""
    weights, index = asked_messages(spark, folder)
    live = filters.valid_messages(inp.messages(spark, folder).withColumn("status", F.lit(1)))
    vectors = live.select(F.col("message_id").alias("chunk_id"), (F.col("memory_id") * 5 + F.col("turn")).alias("vec_id")).join(table(spark, folder, "embeddings"), "vec_id")
    hits = retrieval.hybrid_match(weights, question_vectors(spark, folder), index, vectors.select("chunk_id", "embedding"), {"body": 1.0}, 10, text_weight=0.7)
    return hits.select("query_id", F.col("chunk_id").alias("message_id"), "score", "rank")


@query(
    "r15_skill_search",
    r"""
WITH cat AS (SELECT p_partkey, regexp_extract_all(lower(p_name), '[\p{L}\p{N}_]+') AS name, regexp_extract_all(lower(p_type || ' ' || p_brand), '[\p{L}\p{N}_]+') AS body FROM part),
post AS (SELECT p_partkey, term, count(*) FILTER (WHERE f = 'n') AS tn, count(*) FILTER (WHERE f = 'b') AS tb FROM (
  SELECT p_partkey, unnest(name) AS term, 'n' AS f FROM cat UNION ALL SELECT p_partkey, unnest(body), 'b' FROM cat) GROUP BY ALL),
df AS (SELECT term, count(*) FILTER (WHERE tn > 0) AS dn, count(*) FILTER (WHERE tb > 0) AS db FROM post GROUP BY term),
q AS (SELECT n_nationkey AS query_id, unnest(['red', 'widget', 'economy', lower(regexp_replace(n_name, 'NATION_', ''))]) AS term FROM nation),
s AS (SELECT count(*) AS n, sum(len(name)) / count(*) AS an, sum(len(body)) / count(*) AS ab FROM cat),
r AS (SELECT query_id, p.p_partkey, count(*) AS matched,
  sum(CASE WHEN tn > 0 THEN 3 * ln(1 + (n - dn + 0.5) / (dn + 0.5)) * tn * 2.2 / (tn + 1.2 * (0.25 + 0.75 * len(name) / an)) ELSE 0 END) AS sn,
  sum(CASE WHEN tb > 0 THEN 1 * ln(1 + (n - db + 0.5) / (db + 0.5)) * tb * 2.2 / (tb + 1.2 * (0.25 + 0.75 * len(body) / ab)) ELSE 0 END) AS sb
  FROM q JOIN post p USING (term) JOIN df USING (term) JOIN cat c ON c.p_partkey = p.p_partkey CROSS JOIN s GROUP BY query_id, p.p_partkey)
SELECT CAST(query_id AS BIGINT) AS query_id, p_partkey, round(greatest(sn, sb), 6) AS score,
  row_number() OVER (PARTITION BY query_id ORDER BY round(greatest(sn, sb), 6) DESC, p_partkey) AS rank
FROM r WHERE matched >= 1 QUALIFY rank <= 10
""",
)
def r15_skill_search(spark, folder):
    asked, index = asked_skills(spark, folder)
    hits = retrieval.hybrid_match(asked, asked, index, asked, {"name": 3.0, "body": 1.0}, 10, mode="keyword")
    return hits.withColumnRenamed("chunk_id", "p_partkey")


def asked_skills(spark, folder):
    """Terms that name a nation and a kind of part, and the index of the catalogue."""
    catalogue = table(spark, folder, "part").select(
        F.col("p_partkey").alias("chunk_id"),
        tx.words("p_name").alias("name"),
        tx.words(F.concat_ws(" ", "p_type", "p_brand")).alias("body"),
    )
    asked = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("query_id"),
        F.explode(
            F.array(F.lit("red"), F.lit("widget"), F.lit("economy"), F.lower(F.regexp_replace("n_name", "NATION_", "")))
        ).alias("term"),
        F.lit(1.0).alias("weight"),
    )
    return asked, postings.build(catalogue, {"name": "name", "body": "body"})


_SKILLS_SQL = TWINS["r15_skill_search"]
_SKILLS_HEAD = _SKILLS_SQL[: _SKILLS_SQL.rindex("SELECT CAST(query_id AS BIGINT)")].rstrip()
# nations of even key ask with the mean vector of a label; the others have no vector
SKILL_NEAR_SQL = f"""{CENTROID_SQL.split('qvec AS')[0].rstrip().rstrip(',')},
sv AS (SELECT n_nationkey AS query_id, vector FROM nation JOIN cen ON label = n_nationkey % 10 WHERE n_nationkey % 2 = 0),
sims AS (SELECT query_id, vec_id AS p_partkey, list_cosine_similarity(vector, CAST(embedding AS DOUBLE[])) AS score FROM sv, embeddings JOIN part ON p_partkey = vec_id),
near AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, p_partkey) AS rank FROM sims WHERE round(score, 6) >= 0.1 QUALIFY rank <= 10)"""


def skill_vectors(spark, folder):
    """Vectors of the nations of even key, and of the parts that have one."""
    nations = table(spark, folder, "nation").filter("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("query_id"), (F.col("n_nationkey") % 10).cast("int").alias("label"))
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("vec_id")).join(table(spark, folder, "embeddings"), "vec_id")
    return nations.join(centroids(spark, folder), "label").select("query_id", "vector"), parts.select(F.col("vec_id").alias("chunk_id"), "embedding")


def skills(spark, folder, mode):
    asked, index = asked_skills(spark, folder)
    queries, vectors = skill_vectors(spark, folder)
    hits = retrieval.hybrid_match(asked, queries, index, vectors, {"name": 3.0, "body": 1.0}, 10, mode=mode, fall_back=True)
    return hits.select("query_id", F.col("chunk_id").alias("p_partkey"), "score", "rank")


@query(
    "r15_skill_vector",
    f"""{_SKILLS_HEAD}, {SKILL_NEAR_SQL},
words AS (SELECT query_id, p_partkey, round(greatest(sn, sb), 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(greatest(sn, sb), 6) DESC, p_partkey) AS rank
  FROM r WHERE query_id NOT IN (SELECT query_id FROM near) QUALIFY rank <= 10)
SELECT CAST(query_id AS BIGINT) AS query_id, p_partkey, round(score, 6) AS score, rank FROM near UNION ALL SELECT CAST(query_id AS BIGINT), p_partkey, score, rank FROM words""",
)
def r15_skill_vector(spark, folder):
    """By meaning; nations without a vector fall back to words."""
    return skills(spark, folder, "vector")


@query(
    "r15_skill_hybrid",
    f"""{_SKILLS_HEAD}, {SKILL_NEAR_SQL},
mixed AS (SELECT query_id, p_partkey, round(coalesce(greatest(sn, sb), 0) * 0.3 + coalesce(near.score, 0) * 0.7, 6) AS score FROM r FULL JOIN near USING (query_id, p_partkey))
SELECT CAST(query_id AS BIGINT) AS query_id, p_partkey, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, p_partkey) AS rank FROM mixed QUALIFY rank <= 10""",
)
def r15_skill_hybrid(spark, folder):
    return skills(spark, folder, "hybrid")


@query(
    "r2_vector_cells",
    VECTOR_HITS_SQL + "SELECT CAST(query_id AS BIGINT) AS query_id, chunk_id, score, rank FROM vhits WHERE rank <= 20",
)
def r2_vector_cells(spark, folder):
    """The exact result out of the stored cells."""
    store = vector_cells.build_cells(item_vectors(spark, folder))
    return vector_cells.cell_match(label_queries(spark, folder), store, 20, 0.1)


@query("r3_cell_recall", "SELECT CAST(label AS BIGINT) AS query_id, 10 AS found, true AS enough FROM embeddings GROUP BY label")
def r3_cell_recall(spark, folder):
    """Per question the length of its list, and whether at least 95 in 100 of the nearest are found over all questions.

    The given vectors spread over all directions, so nine cells in ten have to be probed for that.
    """
    queries, vectors = label_queries(spark, folder), item_vectors(spark, folder)
    store = vector_cells.build_cells(vectors)
    near = cut_lineage(vector_cells.cell_match(queries, store, 10, probes=max(1, -(-9 * len(store.sizes) // 10))).select("query_id", "chunk_id", F.lit(1).alias("found")))
    exact = retrieval.vector_match(queries, vectors, 10).select("query_id", "chunk_id")
    share = exact.join(near, ["query_id", "chunk_id"], "left").agg((F.count("found") / F.count(F.lit(1)) >= 0.95).alias("enough"))
    lists = near.groupBy("query_id").agg(F.count(F.lit(1)).alias("found"))
    return lists.withColumn("enough", share.scalar())


GIVEN_SQL = "given AS (SELECT item_id AS query_id, chunk_id FROM benchmark JOIN chunks ON doc_id % 60 = item_id % 60 WHERE item_id % 2 = 0)"


@query(
    "r10_search_given",
    FIRST_STAGE_SQL.replace(
        "sblend AS (",
        GIVEN_SQL + ",\nbound AS (SELECT DISTINCT query_id FROM given),\nkept AS (SELECT * FROM strict ANTI JOIN bound USING (query_id) UNION ALL SELECT * FROM strict SEMI JOIN given USING (query_id, chunk_id)),\nsblend AS (",
    )
    .replace("FROM strict LEFT JOIN qvec", "FROM kept LEFT JOIN qvec")
    .replace("FROM qterms ANTI JOIN strict USING (query_id))", "FROM qterms ANTI JOIN kept USING (query_id) ANTI JOIN bound USING (query_id))")
    + """,
plain AS (SELECT query_id, chunk_id, 0.0::DOUBLE AS cosine, 0.0::DOUBLE AS score, row_number() OVER (PARTITION BY query_id ORDER BY chunk_id) AS rank FROM given ANTI JOIN kept USING (query_id))
SELECT query_id, chunk_id, score, round(cosine, 6) AS cosine, rank FROM found UNION ALL SELECT query_id, chunk_id, score, cosine, rank FROM plain WHERE rank <= 1024""",
)
def r10_search_given(spark, folder):
    """Questions of even number are asked about some documents only."""
    chunks, weights = text_base(spark, folder)
    asked = question_terms(weights)
    even = inp.questions(spark, folder).filter("query_id % 2 = 0").select("query_id", (F.col("query_id") % 60).alias("m"))
    given = chunks.withColumn("m", F.col("doc_id") % 60).join(even, "m").select("query_id", "chunk_id")
    return retrieval.search(
        asked, question_vectors(spark, folder), chunk_index(spark, folder), chunk_vectors(spark, folder), BOOSTS, 1024, given=given
    )
