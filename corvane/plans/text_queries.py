"""Token statistics, term weights and text retrieval (K ids and the text half of R)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import text as tx
from corvane.operators import ordering, postings, retrieval, terms
from corvane.plans import inputs as inp
from corvane.plans.registry import query, table
from corvane.session import cut_lineage
from corvane.plans.term_sql import COUNTS_SQL, QUERY_WEIGHTS_SQL, RAW_WEIGHT_SQL, RETRIEVAL_BASE, STATS_SQL, text_hits_sql

FIELDS = {"content": "tokens", "title": "title_tokens"}
BOOSTS = {"content": 2.0, "title": 10.0}


_STORES: dict[tuple, object] = {}


def stored(spark, folder, name, make):
    """What ``make`` writes for the documents of the folder: once for a session and as long as their files are the same."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{folder}/documents.parquet")
    seen = files.agg(F.count(F.lit(1)), F.sum("length"), F.max("modificationTime"), F.sum(F.crc32(F.col("path").cast("binary")))).first()
    mark = (spark.sparkContext.applicationId, name, folder, *seen)
    if mark not in _STORES:
        _STORES[mark] = make()
    return _STORES[mark]


def document_words(spark, folder):
    return table(spark, folder, "documents").select("doc_id", tx.words("text").alias("tokens"))


def corpus_statistics(spark, folder, vocabulary=None):
    stats = stored(spark, folder, "statistics", lambda: cut_lineage(terms.document_frequency(document_words(spark, folder), "doc_id")))
    return stats if vocabulary is None else stats.join(vocabulary.select("token").distinct(), "token", "left_semi")


def question_weights(spark, folder):
    """Term weights of the question set, from the corpus statistics of its own words."""
    rows = terms.explode_tokens(
        inp.questions(spark, folder).select("query_id", tx.words(tx.normalize_query("text")).alias("tokens")), "query_id"
    )
    return cut_lineage(terms.term_weights(rows, corpus_statistics(spark, folder, rows), "query_id"))


def question_terms(weights):
    return weights.groupBy("query_id", F.col("token").alias("term")).agg(F.sum("weight").alias("weight"))


def indexed_chunks(spark, folder):
    """Chunks with their tokens, the title tokens (the document's first line) and a document name.

    Written once, since matching, statistics and re-ranking all read it.
    """
    titled = table(spark, folder, "documents").select(  # before the lines are, or each line has the whole text and its title anew
        "doc_id", "source", tx.words(F.substring_index("text", "\n", 1)).alias("title_tokens"), F.split("text", "\n").alias("lines")
    )
    return cut_lineage(
        titled.select("doc_id", "source", "title_tokens", F.posexplode("lines").alias("ord", "content"))
        .filter(F.col("content").rlike(r"\S"))
        .select(
            F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.col("ord").cast("string"))).alias("chunk_id"),
            "doc_id",
            F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("doc_name"),
            tx.words("content").alias("tokens"),
            "title_tokens",
        )
    )


def text_base(spark, folder):
    """What every text query starts from: the stored chunk table and the weights of the questions."""
    return stored(spark, folder, "chunks", lambda: indexed_chunks(spark, folder)), question_weights(spark, folder)


def chunk_index(spark, folder):
    """The stored index of the chunks, which all text queries read."""
    return stored(spark, folder, "index", lambda: postings.build(text_base(spark, folder)[0], FIELDS))


def text_hits(spark, folder, base=None, topn=None):
    """Text hits of the question set."""
    weights = (text_base(spark, folder) if base is None else base)[1]
    return retrieval.text_match(question_terms(weights), chunk_index(spark, folder), BOOSTS, 0.3, topn, skip_blocks=False)


@query(
    "k1_tokenize",
    f"""
WITH {inp.CHUNKS_SQL}
SELECT chunk_id, array_to_string({inp.sql_words('content')}, ' ') AS tokens,
       array_to_string(regexp_extract_all(replace(lower(content), '_', ' '), '\\p{{L}}+|\\p{{N}}+'), ' ') AS fine_tokens
FROM chunks
""",
)
def k1_tokenize(spark, folder):
    return terms.tokenize(inp.chunks(spark, folder)).select(
        "chunk_id", F.array_join("tokens", " ").alias("tokens"), F.array_join("fine_tokens", " ").alias("fine_tokens")
    )


@query("k2_document_frequency", f"WITH {STATS_SQL} SELECT token, df, tf FROM stats")
def k2_document_frequency(spark, folder):
    return terms.document_frequency(document_words(spark, folder), "doc_id")


@query(
    "k3_term_weights",
    f"""
WITH {STATS_SQL}, {QUERY_WEIGHTS_SQL}
SELECT query_id, CAST(pos AS BIGINT) AS pos, token, round(weight, 6) AS weight FROM qw
""",
)
def k3_term_weights(spark, folder):
    return question_weights(spark, folder).select("query_id", "pos", "token", "weight")


@query("k4_token_merge")
def k4_token_merge(spark, folder):
    tokens = tx.words("content")
    return inp.chunks(spark, folder).select("chunk_id", F.array_join(terms.token_merge(tokens, ["a"]), "|").alias("terms"))


@query(
    "k5_query_terms",
    f"""
WITH {STATS_SQL}, {QUERY_WEIGHTS_SQL},
allterms AS (
  SELECT query_id, 'term' AS kind, token AS term, weight FROM qw
  UNION ALL
  SELECT query_id, 'synonym', unnest([token || 's', 'the ' || token]), weight / 4 FROM qw JOIN stats USING (token) WHERE df >= 100
  UNION ALL
  SELECT a.query_id, 'pair', a.token || ' ' || b.token, 2 * greatest(a.weight, b.weight)
  FROM qw a JOIN qw b ON a.query_id = b.query_id AND b.pos = a.pos + 1)
SELECT query_id, kind, term, round(sum(weight), 6) AS weight FROM allterms GROUP BY ALL
""",
)
def k5_query_terms(spark, folder):
    stats = corpus_statistics(spark, folder)
    dictionary = stats.filter("df >= 100").select(
        "token", F.array(F.concat("token", F.lit("s")), F.concat(F.lit("the "), "token")).alias("synonyms")
    )
    return terms.query_terms(inp.questions(spark, folder), stats, dictionary)


@query(
    "j12_synonym_expand",
    f"""
WITH {STATS_SQL}, {QUERY_WEIGHTS_SQL}
SELECT query_id, CAST(pos AS BIGINT) AS pos, token, unnest([token || '1', token || '2', token || '3', token || '4',
       token || '5', token || '6', token || '7', token || '8']) AS synonym, round(weight / 4, 6) AS weight
FROM qw JOIN stats USING (token) WHERE df >= 100
""",
)
def j12_synonym_expand(spark, folder):
    stats = corpus_statistics(spark, folder)
    dictionary = stats.filter("df >= 100").select(
        "token", F.array(*[F.concat("token", F.lit(str(i))) for i in range(1, 11)]).alias("synonyms")
    )
    return terms.synonym_expand(question_weights(spark, folder), dictionary)


PARAGRAPH_SQL = f"""ptok AS (SELECT DISTINCT doc_id, unnest({inp.sql_words('text')}) AS token FROM documents),
praw AS (SELECT doc_id, token, round({RAW_WEIGHT_SQL}, 6) AS weight FROM (SELECT doc_id, token, {COUNTS_SQL} FROM ptok LEFT JOIN stats USING (token))),
ptop AS (SELECT doc_id, token AS term, weight, row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, token) AS rank FROM praw),
para AS (SELECT doc_id, term, weight, rank, CAST(least(3, round_even(count(*) OVER (PARTITION BY doc_id) / 10.0, 0)) AS BIGINT) AS need
  FROM ptop WHERE rank <= 30)"""


def paragraphs(spark, folder):
    return terms.paragraph_query(document_words(spark, folder), corpus_statistics(spark, folder), "doc_id")


@query("k6_paragraph_query", f"WITH {STATS_SQL}, {PARAGRAPH_SQL} SELECT doc_id, term, weight, rank, need FROM para")
def k6_paragraph_query(spark, folder):
    return paragraphs(spark, folder).select("doc_id", "term", "weight", "rank", "need")


@query(
    "k7_chunk_keywords",
    f"""
WITH {STATS_SQL}, n AS (SELECT count(*) AS documents FROM documents),
dt AS (SELECT doc_id, token, count(*) AS c FROM (SELECT doc_id, unnest({inp.sql_words('text')}) AS token FROM documents) GROUP BY ALL),
r AS (SELECT doc_id, token, row_number() OVER (PARTITION BY doc_id ORDER BY round(c * ln(documents / df), 6) DESC, token) AS rank
  FROM dt JOIN stats USING (token) CROSS JOIN n)
SELECT doc_id, string_agg(token, ',' ORDER BY rank) AS keywords FROM r WHERE rank <= 5 GROUP BY doc_id
""",
)
def k7_chunk_keywords(spark, folder):
    docs = document_words(spark, folder)
    total = docs.agg(F.count(F.lit(1)).alias("documents"))
    words = terms.chunk_keywords(docs, corpus_statistics(spark, folder), total, "doc_id", 5)
    return words.select("doc_id", F.array_join("keywords", ",").alias("keywords"))


@query(
    "k8_split_keywords",
    r"""
SELECT doc_id, array_to_string(list_filter(list_transform(regexp_split_to_array(text, '[,，;；、\r\n]+'), lambda x: trim(x)),
       lambda x: x <> ''), '|') AS keywords
FROM documents
""",
)
def k8_split_keywords(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", F.array_join(tx.split_keywords("text"), "|").alias("keywords")
    )


@query(
    "w10_bigrams",
    f"""
WITH {inp.CHUNKS_SQL}, t AS (SELECT chunk_id, {inp.sql_words('content')} AS w FROM chunks)
SELECT chunk_id, array_to_string(list_transform(w[1:-2], lambda x, i: x || ' ' || w[i + 1]), '|') AS bigrams FROM t
""",
)
def w10_bigrams(spark, folder):
    return inp.chunks(spark, folder).select(
        "chunk_id", F.array_join(ordering.bigrams(tx.words("content")), "|").alias("bigrams")
    )


@query(
    "r1_text_match",
    f"{RETRIEVAL_BASE},\n{text_hits_sql('hits', 0.3)}\nSELECT query_id, chunk_id, round(score, 6) AS score, matched FROM hits",
)
def r1_text_match(spark, folder):
    return text_hits(spark, folder)
