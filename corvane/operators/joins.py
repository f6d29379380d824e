"""Joins over hits, documents and messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions import scalars as sc
from corvane.operators import ordering, retrieval


def children_to_parents(hits: DataFrame, parents: DataFrame) -> DataFrame:
    """Hits with a known parent give way to the parent: mean score of its hit children, their tokens and keywords joined.

    ``hits(query_id, chunk_id, parent_id, score, tokens, important)``, ``parents(parent_id, content)``. Children
    without a stored parent stay. Hits are top-k lists, so a parent's children are few.
    """
    known = parents.select("parent_id", F.col("content").alias("_content"))
    joined = hits.join(known, "parent_id", "left")
    in_order = lambda c: F.transform(
        F.array_sort(F.collect_list(F.struct(-F.col("score"), F.col("chunk_id"), F.col(c).alias("v")))), lambda e: e["v"]
    )
    merged = (
        joined.filter(F.col("_content").isNotNull())
        .groupBy("query_id", F.col("parent_id").alias("hit_id"))
        .agg(
            F.avg("score").alias("score"),
            F.flatten(in_order("tokens")).alias("tokens"),
            F.flatten(in_order("important")).alias("important"),
            F.count(F.lit(1)).alias("children"),
        )
    )
    alone = joined.filter(F.col("_content").isNull()).select(
        "query_id", F.col("chunk_id").alias("hit_id"), "score", "tokens", "important", F.lit(0).cast("bigint").alias("children")
    )
    return merged.unionByName(alone)


def toc_scores(votes: DataFrame, floor: float = 0.3) -> DataFrame:
    """Mean of a fifth of each vote per (query, chunk), kept from ``floor`` on; votes below one do not count."""
    return (
        votes.filter(F.col("vote") >= 1)
        .groupBy("query_id", "doc_id", "chunk_id")
        .agg(F.round(F.avg(F.col("vote") / 5.0), 6).alias("toc_score"))
        .filter(F.col("toc_score") >= floor)
    )


def boost_by_toc(hits: DataFrame, scores: DataFrame, topn: int) -> DataFrame:
    """Add contents-page scores of each query's best document to its hits, or insert them as new hits.

    The best document has the largest sum of hit scores.
    """
    best = (
        hits.groupBy("query_id", "doc_id")
        .agg(F.round(F.sum("score"), 6).alias("_sum"))
        .groupBy("query_id")
        .agg(F.max_by("doc_id", F.struct(F.col("_sum"), -F.col("doc_id"))).alias("doc_id"))
    )
    extra = scores.join(best, ["query_id", "doc_id"], "left_semi")
    both = hits.join(extra, ["query_id", "doc_id", "chunk_id"], "full").withColumn(
        "score", F.round(F.coalesce("score", F.lit(0.0)) + F.coalesce("toc_score", F.lit(0.0)), 6)
    )
    return ordering.topk_per_query(both.select("query_id", "doc_id", "chunk_id", "score"), topn)


def merge_research_hits(first: DataFrame, second: DataFrame) -> DataFrame:
    """Hits of two rounds; a chunk found in both keeps its first-round row."""
    return first.unionByName(second.join(first.select("query_id", "chunk_id"), ["query_id", "chunk_id"], "left_anti"))


def enrich_with_metadata(hits: DataFrame, meta: DataFrame, fields: Sequence[str], limit: int = 1000) -> DataFrame:
    """Add a map of the wanted metadata fields to each hit; several values of a field are joined."""
    per_doc = (
        meta.filter(F.col("key").isin(*fields))
        .groupBy("doc_id", "key")
        .agg(F.array_join(F.array_sort(F.collect_set("value")), ", ").alias("value"))
        .groupBy("doc_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("metadata"))
    )
    return hits.join(per_doc, "doc_id", "left")


def doc_list_join(
    documents: DataFrame, links: DataFrame, files: DataFrame, flows: DataFrame, users: DataFrame
) -> DataFrame:
    """Documents with their file (inner), their processing flow and their creator (both optional)."""
    return (
        documents.join(links, "doc_id")
        .join(files, "file_id")
        .join(flows, "flow_id", "left")
        .join(users, "user_id", "left")
    )


def raw_with_extracts(raw: DataFrame, extracts: DataFrame) -> DataFrame:
    """Raw messages with the sorted ids of their extracted children, one row each; messages without any have none."""
    listed = (
        extracts.select(F.col("source_id").alias("message_id"), F.col("message_id").alias("extract_id"))
        .groupBy("message_id")
        .agg(F.array_sort(F.collect_list("extract_id")).alias("extracts"))
    )
    return raw.join(listed, "message_id", "left").withColumn("extracts", F.coalesce("extracts", F.array().cast("array<string>")))


def metadata_facets(documents: DataFrame, meta: DataFrame) -> DataFrame:
    """Documents per metadata key and value; documents without any metadata count under a null key."""
    return (
        documents.select("doc_id")
        .join(meta, "doc_id", "left")
        .groupBy("key", "value")
        .agg(F.countDistinct("doc_id").alias("n"))
    )


def piece_scores(pieces: DataFrame, hits: DataFrame, text_weight: float = 0.1, vector_weight: float = 0.9) -> DataFrame:
    """Hybrid score of each answer sentence against the hits of its own answer.

    ``pieces(answer_id, piece, features, feature_total, vector)``, ``hits(answer_id, chunk_id, tokens, embedding)``.
    The hits of an answer are a top-k list, so a sentence meets at most k chunks.
    """
    token_part = retrieval.token_similarity(F.col("features"), F.col("feature_total"), F.col("tokens"))
    vector_part = F.coalesce(sc.cosine(F.col("vector"), F.col("embedding").cast("array<double>")), F.lit(0.0))
    score = F.when(vector_part == 0, token_part).otherwise(token_part * text_weight + vector_part * vector_weight)
    return pieces.join(hits, "answer_id").select("answer_id", "piece", "chunk_id", F.round(score, 6).alias("score"))


def citation_join(
    scored: DataFrame,
    start: float = 0.63,
    decay: float = 0.8,
    floor: float = 0.3,
    top_share: float = 0.99,
    limit: int = 4,
) -> DataFrame:
    """Citations ``(answer_id, chunk_id, piece, score)`` out of the scores of answer sentences.

    The threshold of an answer starts at ``start`` and falls by ``decay`` while nothing is cited and it is above
    ``floor``. Each piece cites all chunks above ``top_share`` of its best score, at most ``limit``, and a chunk is
    cited once, by its first piece.
    """
    best = scored.groupBy("answer_id", "piece").agg(F.max("score").alias("_best"))
    steps = F.array(*[F.lit(round(t, 9)) for t in _thresholds(start, decay, floor)])
    top = best.groupBy("answer_id").agg(F.max("_best").alias("_top"))
    threshold = top.select(
        "answer_id", F.try_element_at(F.filter(steps, lambda t: F.col("_top") >= t), F.lit(1)).alias("_threshold")
    ).filter(F.col("_threshold").isNotNull())
    cited = (
        scored.join(best, ["answer_id", "piece"])
        .join(threshold, "answer_id")
        .filter((F.col("_best") >= F.col("_threshold")) & (F.col("score") > F.col("_best") * top_share))
    )
    order = Window.partitionBy("answer_id", "piece").orderBy(F.col("score").desc(), "chunk_id")
    kept = cited.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= limit)
    return kept.groupBy("answer_id", "chunk_id").agg(
        F.min("piece").alias("piece"), F.min_by("score", "piece").alias("score")
    )


def _thresholds(start: float, decay: float, floor: float) -> list[float]:
    steps, value = [], start
    while value > floor:
        steps.append(value)
        value *= decay
    return steps
