"""Tagging, feedback, metadata edits and evaluation (M ids, J14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import text as tx
from corvane.operators import aggregates, evaluation, joins, postings, retrieval, tagging, terms
from corvane.plans import inputs as inp
from corvane.plans.registry import TWINS, query, table
from corvane.plans.retrieval_queries import TEXT_HITS_SQL, question_vectors, chunk_vectors, top_text_hits
from corvane.plans.term_sql import FEATURES_SQL, QUERY_WEIGHTS_SQL, STATS_SQL
from corvane.plans.text_queries import PARAGRAPH_SQL, corpus_statistics, paragraphs, question_terms, question_weights, stored, text_base
from corvane.session import cut_lineage

def tagged_sql(smoothing):
    return f"""tagged AS (SELECT doc_id AS chunk_id, source AS tag FROM documents JOIN labels USING (doc_id)),
portion AS (SELECT tag, (count(*) + 1) / (sum(count(*)) OVER () + {smoothing}) AS portion FROM tagged GROUP BY tag),
tindex AS (SELECT DISTINCT doc_id AS chunk_id, unnest({inp.sql_words('text')}) AS term FROM documents SEMI JOIN labels USING (doc_id))"""


def scores_sql(key, smoothing):
    return f"""cnt AS (SELECT {key}, tag, count(*) AS c FROM matches JOIN tagged USING (chunk_id) GROUP BY ALL),
sc AS (SELECT {key}, tag, round_even(round(0.1 * (c + 1) / (sum(c) OVER (PARTITION BY {key}) + {smoothing}) / greatest(1e-6, portion), 9), 0) AS score FROM cnt JOIN portion USING (tag)),
rk AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY score DESC, tag) AS rank FROM sc)"""


def tagged_corpus(spark, folder, smoothing=1000):
    """Labelled documents carry their source as tag: the portions of the tags and the stored index."""
    docs = table(spark, folder, "documents").join(table(spark, folder, "labels").select("doc_id"), "doc_id", "left_semi")
    tags = docs.select(F.col("doc_id").alias("chunk_id"), F.col("source").alias("tag"))
    tagged = docs.select(F.col("doc_id").alias("chunk_id"), F.array("source").alias("tags"), F.array_distinct(tx.words("text")).alias("terms"))
    index = stored(spark, folder, "tagged", lambda: postings.build(cut_lineage(tagged), {"text": "terms"}, carry=["tags"]))
    return aggregates.tag_portions(tags, smoothing), index


@query(
    "m1_tag_chunks",
    f"""
WITH {STATS_SQL}, {PARAGRAPH_SQL}, {tagged_sql(1)},
matches AS (SELECT doc_id, chunk_id FROM para JOIN tindex USING (term) GROUP BY doc_id, chunk_id HAVING count(*) >= greatest(1, max(need))),
{scores_sql('doc_id', 1)}
SELECT doc_id, tag, score, rank FROM rk WHERE rank <= 3 AND score > 0
""",
)
def m1_tag_chunks(spark, folder):
    portions, index = tagged_corpus(spark, folder, 1)
    needs = cut_lineage(paragraphs(spark, folder).select("doc_id", "term", "need"))
    return tagging.tag_chunks(needs, index, portions, "doc_id", smoothing=1)


@query(
    "m2_tag_queries",
    f"""
WITH {STATS_SQL}, {QUERY_WEIGHTS_SQL}, {tagged_sql(1000)},
matches AS (SELECT query_id, chunk_id FROM qterms JOIN tindex USING (term) GROUP BY query_id, chunk_id),
{scores_sql('query_id', 1000)}
SELECT query_id, tag, greatest(score, 1.0) AS score, rank FROM rk WHERE rank <= 3
""",
)
def m2_tag_queries(spark, folder):
    portions, index = tagged_corpus(spark, folder)
    return tagging.tag_queries(question_terms(question_weights(spark, folder)), index, portions)


@query(
    "m3_edit_tags",
    """
SELECT doc_id, CASE lang WHEN 'en' THEN 'english,' || source ELSE lang || ',' || source END AS renamed, CASE WHEN source = 'src3' THEN lang ELSE lang || ',' || source END AS removed FROM documents
""",
)
def m3_edit_tags(spark, folder):
    tags = F.array("lang", "source")
    return table(spark, folder, "documents").select(
        "doc_id",
        F.array_join(tagging.rename_tag(tags, "en", "english"), ",").alias("renamed"),
        F.array_join(tagging.remove_tag(tags, "src3"), ",").alias("removed"),
    )


CITED_SQL = """cited AS (
  SELECT event_id, CASE event_type WHEN 'click' THEN 5 ELSE -7 END AS budget, d AS position, (event_id * 7 + d * 13) % 200 AS chunk_id,
    CASE WHEN d = 2 THEN 1.0 ELSE value + d END AS signal
  FROM events, (SELECT unnest([0, 1, 2]) AS d) p WHERE event_type IN ('click', 'error')),
parts AS (SELECT *, abs(budget) * signal / sum(signal) OVER (PARTITION BY event_id) AS raw FROM cited),
fl AS (SELECT *, floor(round(raw, 9)) AS w, round(raw - floor(round(raw, 9)), 9) AS rest FROM parts),
lf AS (SELECT *, abs(budget) - sum(w) OVER (PARTITION BY event_id) AS lo, row_number() OVER (PARTITION BY event_id ORDER BY rest DESC, position) AS rn FROM fl),
deltas AS (SELECT event_id, chunk_id, CAST(sign(budget) * (w + CASE WHEN rn <= lo THEN 1 ELSE 0 END) AS BIGINT) AS delta FROM lf)"""


def cited_chunks(spark, folder):
    """Each click praises and each error blames three chunks; the third has no score."""
    place = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("position")
    events = table(spark, folder, "events").filter(F.col("event_type").isin("click", "error"))
    cited = events.select("event_id", F.when(F.col("event_type") == "click", 5).otherwise(-7).alias("budget"), place, "value")
    score = F.when(F.col("position") != 2, F.col("value") + F.col("position"))
    return cited.select(
        "event_id", "budget", "position", ((F.col("event_id") * 7 + F.col("position") * 13) % 200).alias("chunk_id"),
        tagging.retrieval_signal([score, F.lit(-1.0)]).alias("signal"),
    )


@query("m4_feedback_deltas", f"WITH {CITED_SQL} SELECT event_id, chunk_id, delta FROM deltas")
def m4_feedback_deltas(spark, folder):
    return tagging.feedback_deltas(cited_chunks(spark, folder))


@query(
    "m4_uniform_deltas",
    f"WITH {CITED_SQL} SELECT event_id, chunk_id, CAST(sign(budget) AS BIGINT) AS delta FROM cited",
)
def m4_uniform_deltas(spark, folder):
    return tagging.feedback_deltas(cited_chunks(spark, folder), uniform=True)


@query(
    "m5_apply_feedback",
    f"""
WITH {CITED_SQL}, s AS (SELECT chunk_id, sum(delta) AS d FROM deltas GROUP BY chunk_id)
SELECT doc_id AS chunk_id, CASE WHEN d IS NULL THEN CAST(quality AS DOUBLE) ELSE nullif(CAST(least(greatest(coalesce(quality, 0) + d, 0), 100) AS DOUBLE), 0) END AS pagerank
FROM documents LEFT JOIN labels USING (doc_id) LEFT JOIN s ON s.chunk_id = doc_id
""",
)
def m5_apply_feedback(spark, folder):
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").cast("double").alias("pagerank"))
    chunks = table(spark, folder, "documents").select("doc_id").join(labels, "doc_id", "left").withColumnRenamed("doc_id", "chunk_id")
    return tagging.apply_feedback(chunks, tagging.feedback_deltas(cited_chunks(spark, folder)))


@query(
    "m6_set_dataset_weight",
    "SELECT doc_id, CASE WHEN starts_with(source, 'src1') THEN nullif(CAST(length(source) - 4 AS DOUBLE), 0) ELSE CAST(n_chars AS DOUBLE) END AS pagerank FROM documents",
)
def m6_set_dataset_weight(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", F.col("source").alias("dataset_id"), F.col("n_chars").cast("double").alias("pagerank"))
    weights = docs.select("dataset_id").distinct().filter(F.col("dataset_id").startswith("src1")).withColumn("weight", F.length("dataset_id") - 4)
    return tagging.set_dataset_weight(docs, weights).select("doc_id", "pagerank")


@query(
    "m7_edit_metadata",
    """
SELECT doc_id, lang <> 'xx' AS changed, CASE WHEN lang = 'en' THEN 'english' ELSE lang END AS lang, source || ',new' AS tags, 'yes' AS checked
FROM documents WHERE source <> 'src3'
UNION ALL SELECT doc_id, true, CASE WHEN lang = 'en' THEN 'english' ELSE lang END, 'new', 'yes' FROM documents WHERE source = 'src3'
""",
)
def m7_edit_metadata(spark, folder):
    value = lambda v, listed: F.struct(v.alias("values"), F.lit(listed).alias("listed"))
    docs = table(spark, folder, "documents").select(
        "doc_id",
        F.create_map(
            F.lit("lang"), value(F.array("lang"), False), F.lit("tags"), value(F.array("source"), True), F.lit("size"), value(F.array(F.col("n_chars").cast("string")), False)
        ).alias("meta"),
    )
    updates = [
        {"key": "lang", "value": "english", "match": "en"},
        {"key": "tags", "value": "new"},
        {"key": "checked", "value": "yes"},
        {"key": "absent", "value": "x", "match": "y"},
    ]
    edited = tagging.edit_metadata(docs, updates, [{"key": "size"}, {"key": "tags", "value": "src3"}])
    one = lambda key: F.array_join(F.col("meta")[key]["values"], ",").alias(key)
    return edited.select("doc_id", "changed", one("lang"), one("tags"), one("checked"))


RUN_SQL = TEXT_HITS_SQL + """,
run AS (SELECT query_id, chunk_id AS doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, chunk_id) AS position FROM hits QUALIFY position <= 10),
qrels AS (SELECT item_id AS query_id, chunk_id AS doc_id, 1 + (ord % 2) AS rel FROM benchmark JOIN chunks ON ord < 3 AND doc_id % 40 = item_id % 40
  UNION SELECT query_id, doc_id, 3 FROM run WHERE position % 3 = 2)"""


def run_and_qrels(spark, folder):
    """The text run against made relevance: every third hit, and some chunks the run does not know."""
    run = cut_lineage(
        top_text_hits(spark, folder, 10).select("query_id", F.col("chunk_id").alias("doc_id"), "score", F.col("rank").alias("position"))
    )
    questions = inp.questions(spark, folder).select("query_id", (F.col("query_id") % 40).alias("slot"))
    others = (
        inp.chunks(spark, folder).filter("ord < 3")
        .select(F.col("chunk_id").alias("doc_id"), (F.col("doc_id") % 40).alias("slot"), (1 + F.col("ord") % 2).alias("rel"))
        .join(questions, "slot").select("query_id", "doc_id", "rel")
    )
    return run, others.union(run.filter("position % 3 = 2").select("query_id", "doc_id", F.lit(3).cast("bigint"))).distinct()


@query(
    "m11_retrieval_metrics",
    f"""{RUN_SQL},
rel AS (SELECT DISTINCT query_id, doc_id FROM qrels),
f AS (SELECT query_id, count(*) AS n, count(rel.doc_id) AS h, min(position) FILTER (WHERE rel.doc_id IS NOT NULL) AS first FROM run LEFT JOIN rel USING (query_id, doc_id) GROUP BY query_id),
z AS (SELECT query_id, count(*) AS r FROM rel GROUP BY query_id),
m AS (SELECT query_id, coalesce(h / n, 0) AS p, coalesce(h, 0) / r AS rc, coalesce(1.0 / first, 0) AS mrr FROM z LEFT JOIN f USING (query_id))
SELECT query_id, round(p, 6) AS precision, round(rc, 6) AS recall, round(CASE WHEN p + rc > 0 THEN 2 * p * rc / (p + rc) ELSE 0 END, 6) AS f1, CASE WHEN p > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS hit_rate, round(CAST(mrr AS DOUBLE), 6) AS mrr FROM m
""",
)
def m11_retrieval_metrics(spark, folder):
    return evaluation.retrieval_metrics(*run_and_qrels(spark, folder))


@query(
    "m12_ranked_metrics",
    f"""{RUN_SQL},
mx AS (SELECT query_id, doc_id, max(rel) AS rel FROM qrels GROUP BY ALL),
j AS (SELECT query_id, position AS rank, coalesce(rel, 0) AS rel FROM run LEFT JOIN mx USING (query_id, doc_id)),
h AS (SELECT *, sum(CASE WHEN rel > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY query_id ORDER BY rank) AS hits FROM j),
s AS (SELECT query_id, sum(rel / log2(rank + 1)) AS dcg, sum(CASE WHEN rank <= 5 AND rel > 0 THEN hits / rank ELSE 0 END) AS ap, max(CASE WHEN rel > 0 THEN 1.0 / rank ELSE 0 END) AS mrr FROM h GROUP BY query_id),
i AS (SELECT query_id, sum(rel / log2(k + 1)) AS ideal FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rel DESC, doc_id) AS k FROM mx) WHERE k <= 10 GROUP BY query_id),
z AS (SELECT query_id, count(*) AS n FROM mx GROUP BY query_id)
SELECT query_id, round(coalesce(dcg, 0) / ideal, 6) AS ndcg, round(coalesce(ap, 0) / n, 6) AS map, round(CAST(coalesce(mrr, 0) AS DOUBLE), 6) AS mrr FROM i JOIN z USING (query_id) LEFT JOIN s USING (query_id)
""",
)
def m12_ranked_metrics(spark, folder):
    run, qrels = run_and_qrels(spark, folder)
    best = qrels.groupBy("query_id", "doc_id").agg(F.max("rel").alias("rel"))
    return evaluation.ranked_metrics(run, best)


_RANKED_SQL = TWINS["m12_ranked_metrics"]
FULL_RANKED_SQL = _RANKED_SQL.replace("round(coalesce(dcg, 0) / ideal, 6)", "coalesce(dcg, 0) / ideal").replace("round(coalesce(ap, 0) / n, 6)", "coalesce(ap, 0) / n").replace("round(CAST(coalesce(mrr, 0) AS DOUBLE), 6)", "CAST(coalesce(mrr, 0) AS DOUBLE)")


@query("m12_mean_metrics", f"SELECT count(*) AS queries, round(avg(ndcg), 6) AS ndcg, round(avg(map), 6) AS map, round(avg(mrr), 6) AS mrr FROM ({FULL_RANKED_SQL})")
def m12_mean_metrics(spark, folder):
    run, qrels = run_and_qrels(spark, folder)
    return evaluation.mean_metrics(evaluation.ranked_metrics(run, qrels.groupBy("query_id", "doc_id").agg(F.max("rel").alias("rel"))))


@query("m12_worst_first", f"SELECT query_id, ndcg, row_number() OVER (ORDER BY ndcg, query_id) AS place FROM ({_RANKED_SQL})")
def m12_worst_first(spark, folder):
    run, qrels = run_and_qrels(spark, folder)
    metrics = evaluation.ranked_metrics(run, qrels.groupBy("query_id", "doc_id").agg(F.max("rel").alias("rel")))
    return evaluation.worst_first(metrics).select("query_id", "ndcg", "place")


@query(
    "m13_qrels_from_table",
    """
WITH p AS (SELECT conv_id AS query_id, md5(text) AS doc_id, max(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) AS rel FROM conversations GROUP BY ALL)
SELECT query_id, doc_id, CAST(rel AS BIGINT) AS rel FROM p WHERE query_id IN (SELECT query_id FROM p WHERE rel > 0)
""",
)
def m13_qrels_from_table(spark, folder):
    turns = F.array_sort(F.collect_list(F.struct("turn", "text", (F.col("role") == "assistant").cast("int").alias("s"))))
    rows = table(spark, folder, "conversations").groupBy(F.col("conv_id").alias("query_id")).agg(turns.alias("t"))
    rows = rows.select("query_id", F.transform("t", lambda e: e["text"]).alias("passages"), F.transform("t", lambda e: e["s"]).alias("selected"))
    return evaluation.qrels_from_table(rows)[1]


@query(
    "m14_answer_metrics",
    "SELECT conv_id, turn, length(text) AS answer_length, 1.0::DOUBLE AS has_answer FROM conversations WHERE role = 'assistant' AND text <> ''",
)
def m14_answer_metrics(spark, folder):
    answers = table(spark, folder, "conversations").filter("role = 'assistant'")
    return evaluation.answer_metrics(answers, "text").select("conv_id", "turn", "answer_length", "has_answer")


@query(
    "m15_compare_runs",
    """
SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'first only' ELSE 'differs' END AS status, CASE WHEN doc_id % 11 <> 0 THEN CASE WHEN doc_id % 5 = 0 AND doc_id % 7 = 0 THEN 'lang,score' WHEN doc_id % 5 = 0 THEN 'lang' ELSE 'score' END END AS columns
FROM documents WHERE doc_id % 11 = 0 OR doc_id % 5 = 0 OR doc_id % 7 = 0
""",
)
def m15_compare_runs(spark, folder):
    first = table(spark, folder, "documents").select("doc_id", "lang", F.col("n_chars").cast("double").alias("score"))
    second = first.filter("doc_id % 11 <> 0").select(
        "doc_id",
        F.when(F.col("doc_id") % 5 == 0, "zz").otherwise(F.col("lang")).alias("lang"),
        (F.col("score") + F.when(F.col("doc_id") % 7 == 0, 1.0).otherwise(1e-9)).alias("score"),
    )
    return evaluation.compare_runs(first, second, "doc_id", ["lang"], ["score"])


@query("j14_citation_join")
def j14_citation_join(spark, folder):
    """Sentences of each question cite the chunks of its top text hits."""
    base = text_base(spark, folder)
    hits = cut_lineage(top_text_hits(spark, folder, 10, base).select(F.col("query_id").alias("answer_id"), "chunk_id"))
    offered = hits.join(base[0].select("chunk_id", "tokens"), "chunk_id").join(
        chunk_vectors(spark, folder), "chunk_id", "left"
    )
    pieces = inp.questions(spark, folder).select(
        F.col("query_id").alias("answer_id"), F.posexplode(tx.sentences("text")).alias("piece", "sentence")
    ).withColumn("query_id", F.concat_ws(":", "answer_id", "piece"))
    weights = terms.term_weights(
        terms.explode_tokens(pieces, "query_id", tx.words("sentence")), corpus_statistics(spark, folder), "query_id"
    )
    vectors = question_vectors(spark, folder).withColumnRenamed("query_id", "answer_id")
    ready = pieces.join(retrieval.query_features(weights), "query_id").join(vectors, "answer_id", "left")
    return joins.citation_join(joins.piece_scores(ready, offered))
