"""Batch retrieval: a table of questions against a table of chunks, by text, by vector and by both."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions import scalars as sc
from corvane.functions import text as tx
from corvane.operators import filters, ordering
from corvane.operators.postings import PostingStore, text_match
from corvane.session import cut_lineage

# The shares of the score features.
UNIGRAM_SHARE, PAIR_SHARE, EPSILON = 0.4, 0.6, 1e-9
BROADCAST_BYTES = 64 * 1024 * 1024


def _unit(matrix: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, length, out=np.zeros_like(matrix), where=length > 0)


def _best(query_ids, queries, chunk_ids, vectors, topn, min_sim) -> pd.DataFrame:
    """All pairs of one block that can be in a query's top ``topn``, ties at the edge included."""
    sims = _unit(queries) @ _unit(vectors).T
    level = np.round(sims, 6)
    if sims.shape[1] > topn:
        edge = np.partition(level, -topn, axis=1)[:, -topn]
    else:
        edge = np.full(len(sims), -2.0)
    rows, cols = np.nonzero((level >= edge[:, None]) & (level >= min_sim))
    return pd.DataFrame({"query_id": query_ids[rows], "chunk_id": chunk_ids[cols], "score": sims[rows, cols]})


def vector_match(
    queries: DataFrame, vectors: DataFrame, topn: int, min_sim: float = -1.0, block_rows: int = 8192
) -> DataFrame:
    """Exact cosine top ``topn`` per query: ``(query_id, chunk_id, score, rank)``.

    ``queries(query_id, vector)``, ``vectors(chunk_id, embedding)``. Query vectors of a checked size travel to the
    chunk partitions, which multiply batch by batch and send on only their own best rows. A larger question table
    meets the chunks block by block through a shuffle, so neither side is ever held whole.
    """
    query_type = queries.schema["query_id"].dataType.simpleString()
    chunk_type = vectors.schema["chunk_id"].dataType.simpleString()
    schema = f"query_id {query_type}, chunk_id {chunk_type}, score double"
    size = queries.agg(F.coalesce(F.sum(F.size("vector")), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("rows")).first()
    if size["n"] * 8 <= BROADCAST_BYTES:
        small = queries.select("query_id", "vector").toPandas()
        held = queries.sparkSession.sparkContext.broadcast(
            (small["query_id"].to_numpy(), np.array(small["vector"].tolist(), dtype=np.float64))
        )

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            query_ids, matrix = held.value
            for batch in batches:
                if len(batch) and len(query_ids):
                    block = np.array(batch["embedding"].tolist(), dtype=np.float64)
                    yield _best(query_ids, matrix, batch["chunk_id"].to_numpy(), block, topn, min_sim)

        pairs = vectors.select("chunk_id", "embedding").mapInPandas(score, schema)
    else:
        query_blocks = int(-(-size["rows"] // block_rows))
        chunk_blocks = int(-(-vectors.count() // block_rows))
        spread = lambda column, n: F.pmod(F.xxhash64(column), F.lit(n)).cast("int")
        asked = queries.select(
            "query_id",
            "vector",
            spread("query_id", query_blocks).alias("qb"),
            F.explode(F.sequence(F.lit(0), F.lit(chunk_blocks - 1))).alias("cb"),
        )
        stored = vectors.select(
            "chunk_id",
            "embedding",
            spread("chunk_id", chunk_blocks).alias("cb"),
            F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"),
        )

        def score_block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if not len(left) or not len(right):
                return pd.DataFrame({"query_id": [], "chunk_id": [], "score": []})
            return _best(
                left["query_id"].to_numpy(),
                np.array(left["vector"].tolist(), dtype=np.float64),
                right["chunk_id"].to_numpy(),
                np.array(right["embedding"].tolist(), dtype=np.float64),
                topn,
                min_sim,
            )

        pairs = asked.groupBy("qb", "cb").cogroup(stored.groupBy("qb", "cb")).applyInPandas(score_block, schema)
    return ordering.topk_per_query(pairs, topn)


def vector_match_approx(
    queries: DataFrame, vectors: DataFrame, topn: int, distance: float = 1.0, width: float = 0.5, tables: int = 8
) -> DataFrame:
    """Approximate cosine top ``topn`` through random-projection buckets of the unit vectors."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH, Normalizer
    from pyspark.ml.functions import array_to_vector

    unit = Normalizer(inputCol="raw", outputCol="unit")
    left = unit.transform(queries.select("query_id", array_to_vector(F.col("vector").cast("array<double>")).alias("raw")))
    right = unit.transform(
        vectors.select("chunk_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("raw"))
    )
    model = BucketedRandomProjectionLSH(
        inputCol="unit", outputCol="hashes", bucketLength=width, numHashTables=tables, seed=7
    ).fit(right)
    near = model.approxSimilarityJoin(left, right, distance, distCol="distance").select(
        F.col("datasetA.query_id").alias("query_id"),
        F.col("datasetB.chunk_id").alias("chunk_id"),
        (1 - F.col("distance") * F.col("distance") / 2).alias("score"),
    )
    return ordering.topk_per_query(near, topn)


def pair_similarity(pairs: DataFrame, queries: DataFrame, vectors: DataFrame) -> DataFrame:
    """Cosine of given pairs ``(query_id, chunk_id, …)``; 0 without a vector on either side.

    The chunks' vectors come first: pairs move by chunk without the vector of their question.
    """
    return (
        pairs.join(vectors.select("chunk_id", "embedding"), "chunk_id", "left")
        .join(queries.select("query_id", "vector"), "query_id", "left")
        .withColumn(
            "cosine", F.coalesce(sc.cosine(F.col("vector").cast("array<double>"), F.col("embedding").cast("array<double>")), F.lit(0.0))
        )
        .drop("vector", "embedding")
    )


def fuse_scores(
    text_hits: DataFrame,
    vector_hits: DataFrame,
    text_weight: float,
    topn: int,
    pagerank: DataFrame | None = None,
    text_gated: bool = False,
) -> DataFrame:
    """Weighted sum of text and vector hits plus a hundredth of the page rank, best ``topn`` per query.

    A hit of one side only scores 0 on the other. ``text_gated`` keeps text hits only.
    """
    how = "left" if text_gated else "full"
    both = text_hits.select("query_id", "chunk_id", F.col("score").alias("text_score")).join(
        vector_hits.select("query_id", "chunk_id", F.col("score").alias("vector_score")), ["query_id", "chunk_id"], how
    ).na.fill(0.0, ["text_score", "vector_score"])
    rank_part = F.lit(0.0)
    if pagerank is not None:
        both = both.join(pagerank.select("chunk_id", "pagerank"), "chunk_id", "left")
        rank_part = F.coalesce(F.col("pagerank").cast("double"), F.lit(0.0)) / 100
    scored = both.withColumn(
        "score", F.col("text_score") * text_weight + F.col("vector_score") * (1 - text_weight) + rank_part
    ).drop("pagerank")
    return ordering.topk_per_query(scored, topn)


def fuse_text_first(
    text_hits: DataFrame, queries: DataFrame, vectors: DataFrame, text_weight: float, candidates: int, min_sim: float, topn: int
) -> DataFrame:
    """Best text hits first, then the vector threshold and the blended score."""
    first = ordering.topk_per_query(text_hits, candidates).select(
        "query_id", "chunk_id", F.col("score").alias("text_score")
    )
    scored = (
        pair_similarity(first, queries, vectors)
        .withColumnRenamed("cosine", "vector_score")
        .filter(F.round("vector_score", 6) >= min_sim)
        .withColumn("score", F.col("text_score") * text_weight + F.col("vector_score") * (1 - text_weight))
    )
    return ordering.topk_per_query(scored, topn)


def query_features(token_weights: DataFrame) -> DataFrame:
    """Per query a map feature → weight: 0.4 of each term weight, 0.6 of the larger weight of adjacent terms.

    Input ``(query_id, pos, token, weight)``; questions are short texts, so one query's terms fit a row.
    """
    ordered = token_weights.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "token", "weight"))).alias("t")
    )
    t = F.col("t")
    single = F.transform(t, lambda x: F.struct(x["token"].alias("feature"), (x["weight"] * UNIGRAM_SHARE).alias("weight")))
    paired = F.when(
        F.size(t) > 1,
        F.zip_with(
            F.slice(t, F.lit(1), F.size(t) - 1),
            F.slice(t, F.lit(2), F.size(t) - 1),
            lambda a, b: F.struct(
                F.concat(a["token"], b["token"]).alias("feature"),
                (F.greatest(a["weight"], b["weight"]) * PAIR_SHARE).alias("weight"),
            ),
        ),
    ).otherwise(F.array().cast("array<struct<feature:string,weight:double>>"))
    rows = ordered.select("query_id", F.explode(F.concat(single, paired)).alias("e")).select("query_id", "e.*")
    summed = rows.groupBy("query_id", "feature").agg(F.sum("weight").alias("weight"))
    return summed.groupBy("query_id").agg(
        F.map_from_entries(F.collect_list(F.struct("feature", "weight"))).alias("features"),
        F.sum("weight").alias("feature_total"),
    )


def bag_of(content: Column, title: Column | None = None, important: Column | None = None, questions: Column | None = None) -> Column:
    """Token sequence a chunk is compared by: distinct content, title twice, keywords five and questions six times."""
    none = F.array().cast("array<string>")
    parts = [F.array_distinct(content)]
    for column, times in ((title, 2), (important, 5), (questions, 6)):
        if column is not None:
            parts += [F.coalesce(column, none)] * times
    return F.concat(*parts)


def bag_features(bag: Column) -> Column:
    """Distinct terms of the bag and distinct adjacent terms written together."""
    pairs = F.when(
        F.size(bag) > 1,
        F.zip_with(
            F.slice(bag, F.lit(1), F.size(bag) - 1), F.slice(bag, F.lit(2), F.size(bag) - 1), lambda a, b: F.concat(a, b)
        ),
    ).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(bag, pairs))


def token_similarity(features: Column, total: Column, bag: Column) -> Column:
    """Share of the query's feature weight that the bag covers."""
    shared = F.array_intersect(F.map_keys(features), bag_features(bag))
    covered = F.aggregate(shared, F.lit(0.0), lambda s, k: s + F.element_at(features, k))
    return (covered + EPSILON) / (total + EPSILON)


def hybrid_score(pairs: DataFrame, text_weight: float = 0.3, vector_weight: float = 0.7) -> DataFrame:
    """Blend ``token_sim`` and ``cosine``; queries whose cosines add up to 0 use the tokens alone."""
    sums = pairs.groupBy("query_id").agg(F.round(F.sum("cosine"), 9).alias("_cosines"))
    blend = F.col("token_sim") * text_weight + F.col("cosine") * vector_weight
    return pairs.join(sums, "query_id").withColumn(
        "hybrid", F.when(F.col("_cosines") == 0, F.col("token_sim")).otherwise(blend)
    ).drop("_cosines")


def rank_feature_score(query_tags: Column, chunk_tags: Column, pagerank: Column) -> Column:
    """Ten times the cosine over shared tags plus the page rank; the page rank alone without tags."""
    none = F.create_map().cast("map<string,double>")
    q, c = F.coalesce(query_tags, none), F.coalesce(chunk_tags, none)
    squares = lambda m: F.aggregate(F.map_values(m), F.lit(0.0), lambda s, x: s + x * x)
    shared = F.array_intersect(F.map_keys(q), F.map_keys(c))
    dot = F.aggregate(shared, F.lit(0.0), lambda s, k: s + F.element_at(q, k) * F.element_at(c, k))
    base = F.coalesce(pagerank, F.lit(0.0))
    length = F.sqrt(squares(c)) * F.sqrt(squares(q))
    return F.when(length > 0, dot / length * 10 + base).otherwise(base)


def normalize_scores(hits: DataFrame, method: str = "minmax", score: str = "score") -> DataFrame:
    """Scores of each query brought to 0..1 before fusion, by range or by arc tangent."""
    if method == "atan":
        return hits.withColumn("normalized", F.atan(F.col(score)) * 2 / F.lit(np.pi))
    ends = hits.groupBy("query_id").agg(F.min(score).alias("_lo"), F.max(score).alias("_hi"))
    spread = F.col("_hi") - F.col("_lo")
    return (
        hits.join(ends, "query_id")
        .withColumn("normalized", F.when(spread > 0, (F.col(score) - F.col("_lo")) / spread).otherwise(F.lit(1.0)))
        .drop("_lo", "_hi")
    )


def search(
    query_terms: DataFrame,
    queries: DataFrame,
    index: PostingStore,
    vectors: DataFrame,
    boosts: Mapping[str, float],
    topn: int,
    text_weight: float = 0.05,
    min_match: float = 0.3,
    min_sim: float = 0.1,
    relaxed_match: float = 0.1,
    relaxed_sim: float = 0.17,
    given: DataFrame | None = None,
) -> DataFrame:
    """First stage: text hits blended with their vector similarity; questions without a hit are asked again, relaxed.

    ``queries(query_id, vector)``; both passes read one index. ``given(query_id, chunk_id)`` holds the chunks of the
    documents a question is asked about: such a question finds nothing else, and where none of them matches it gets
    them all, unscored, by id.
    """
    scope = None if given is None else cut_lineage(given.select("query_id", "chunk_id").distinct())

    def stage(match: float, sim: float, asked: DataFrame) -> DataFrame:
        hits = text_match(asked, index, boosts, match)
        if scope is not None:
            bound = scope.select("query_id").distinct()
            hits = hits.join(bound, "query_id", "left_anti").unionByName(hits.join(scope, ["query_id", "chunk_id"], "left_semi"))
        near = pair_similarity(hits, queries, vectors)
        vector_part = F.when(F.round("cosine", 6) >= sim, F.col("cosine")).otherwise(0.0)
        blended = near.withColumn("score", F.col("score") * text_weight + vector_part * (1 - text_weight))
        return ordering.topk_per_query(blended.select("query_id", "chunk_id", "score", "cosine"), topn)

    strict = cut_lineage(stage(min_match, min_sim, query_terms))
    missed = query_terms.join(strict.select("query_id").distinct(), "query_id", "left_anti")
    if scope is None:
        return strict.unionByName(stage(relaxed_match, relaxed_sim, missed))
    plain = scope.join(strict.select("query_id").distinct(), "query_id", "left_anti")
    plain = ordering.topk_per_query(plain.withColumns({"score": F.lit(0.0), "cosine": F.lit(0.0)}), topn).select(*strict.columns)
    return strict.unionByName(stage(relaxed_match, relaxed_sim, missed.join(scope.select("query_id").distinct(), "query_id", "left_anti"))).unionByName(plain)


def hybrid_match(
    query_terms: DataFrame,
    queries: DataFrame,
    index: PostingStore,
    vectors: DataFrame,
    boosts: Mapping[str, float],
    topn: int,
    mode: str = "hybrid",
    text_weight: float = 0.3,
    min_match: float = 0.3,
    min_sim: float = 0.1,
    fall_back: bool = False,
) -> DataFrame:
    """Best ``topn`` chunks per question ``(query_id, chunk_id, score, rank)`` by words, by meaning or by both.

    ``mode`` is ``keyword``, ``vector`` or ``hybrid``: the last one adds the text score at ``text_weight`` and the cosine
    of the ``topn`` nearest at the rest, so a chunk that shares no word with the question can be found. With
    ``fall_back``, questions that vectors give nothing get what their words find.
    """
    if mode not in ("keyword", "vector", "hybrid"):
        raise ValueError(f"no search mode {mode}")
    best = lambda hits: ordering.topk_per_query(hits.select("query_id", "chunk_id", "score"), topn)
    if mode == "keyword":
        return best(text_match(query_terms, index, boosts, min_match, topn))
    near = cut_lineage(vector_match(queries, vectors, topn, min_sim).select("query_id", "chunk_id", "score"))
    if mode == "hybrid":
        return best(fuse_scores(text_match(query_terms, index, boosts, min_match), near, text_weight, topn))
    found = best(near)
    if not fall_back:
        return found
    missed = query_terms.join(near.select("query_id").distinct(), "query_id", "left_anti")
    return found.unionByName(best(text_match(missed, index, boosts, min_match, topn)))


def candidate_window(page_size: int, around: int = 64) -> int:
    """Rows re-ranked together: whole pages around ``around``."""
    return page_size * -(-around // page_size)


def rerank(
    hits: DataFrame,
    chunks: DataFrame,
    features: DataFrame,
    text_weight: float,
    vector_weight: float,
    title: str | None = "title_tokens",
    rank_feature: Column | None = None,
    vector_score: str = "cosine",
) -> DataFrame:
    """Second stage: token and vector similarity of the candidates, plus the rank feature column if given.

    ``hits(query_id, chunk_id, cosine)`` or any external score in ``vector_score``.
    """
    title_column = F.col(title) if title else None
    staged = (
        hits.join(chunks, "chunk_id")
        .join(features, "query_id")
        .withColumn("token_sim", token_similarity(F.col("features"), F.col("feature_total"), bag_of(F.col("tokens"), title_column)))
        .withColumn("cosine", F.col(vector_score))
        .drop("features", "feature_total")
    )
    blended = hybrid_score(staged, text_weight, vector_weight)
    extra = rank_feature if rank_feature is not None else F.lit(0.0)
    return blended.withColumn("similarity", F.round(F.col("hybrid") + extra, 6)).drop("hybrid")


def retrieval(
    first_stage: DataFrame,
    chunks: DataFrame,
    documents: DataFrame,
    features: DataFrame,
    page: int = 1,
    page_size: int = 10,
    threshold: float = 0.2,
    vector_weight: float = 0.3,
    rank_feature: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rank a candidate window of every question and cut one page; returns (page rows, document facets).

    The page lies in the window of first-stage ranks that holds its first row: later pages re-rank later windows, so
    the pages of all windows cover every candidate once. ``rank`` counts within the window; ``total`` counts its
    rows over the threshold, which the facets also describe. ``rank_feature`` is a column of ``chunks`` to add.
    """
    window = candidate_window(page_size)
    floor = threshold if vector_weight > 0 else 0.0
    first = (page - 1) * page_size
    passed = first // window * window
    first -= passed
    # written, so that Spark knows how few they are before it joins them with all chunks and documents
    hits = cut_lineage(first_stage.filter((F.col("rank") > passed) & (F.col("rank") <= passed + window)).select("query_id", "chunk_id", "cosine"))
    candidates = filters.prune_orphans(hits.join(chunks.select("chunk_id", "doc_id"), "chunk_id"), documents)
    candidates = cut_lineage(candidates.drop("doc_id"))
    scored = rerank(candidates, chunks, features, 1 - vector_weight, vector_weight, rank_feature=rank_feature)
    valid = ordering.topk_per_query(scored.filter(F.col("similarity") >= floor), window, score="similarity")
    totals = valid.groupBy("query_id").agg(F.count(F.lit(1)).alias("total"))
    rows = valid.filter((F.col("rank") > first) & (F.col("rank") <= first + page_size)).join(totals, "query_id")
    facets = valid.groupBy("query_id", "doc_name").agg(
        F.count(F.lit(1)).alias("n"), F.min_by("doc_id", "rank").alias("doc_id")
    )
    return rows, facets


def filter_browse(chunks: DataFrame, condition: Mapping, order: list[tuple[str, str]], number: int, size: int) -> DataFrame:
    """No question: filter, order and page."""
    return ordering.page(ordering.order_by(chunks.filter(filters.chunk_filter(condition)), order), number, size)


def token_match(tokens: Column, text: Column, share: float = 0.3) -> Column:
    """Whether a token column holds at least ``share`` of the text's distinct words."""
    wanted = F.array_distinct(tx.words(text))
    need = F.greatest(F.lit(1), F.floor(F.size(wanted) * share).cast("int"))
    return F.size(F.array_intersect(wanted, tokens)) >= need


def format_context(hits: DataFrame) -> DataFrame:
    """Hits as prompt blocks: number, title, url and metadata lines (blank ones left out), then the content."""

    def line(name: Column, value: Column) -> Column:
        shown = F.concat(F.lit("├── "), name, F.lit(": "), F.regexp_replace(value, "\n+", " "))
        return F.when(F.coalesce(value, F.lit("")) != "", shown)

    meta = F.transform(
        F.array_sort(F.map_entries(F.coalesce("metadata", F.create_map().cast("map<string,string>")))),
        lambda e: line(e["key"], e["value"]),
    )
    block = F.concat_ws(
        "\n",
        F.concat(F.lit("\nID: "), (F.col("rank") - 1).cast("string")),
        line(F.lit("Title"), F.col("doc_name")),
        line(F.lit("URL"), F.col("url")),
        meta,
        F.lit("└── Content:"),
        F.col("content"),
    )
    return hits.withColumn("block", block)
