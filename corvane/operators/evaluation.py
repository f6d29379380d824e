"""Retrieval quality: set metrics, ranked metrics, relevance tables, comparison of two runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.operators import scans


def retrieval_metrics(run: DataFrame, qrels: DataFrame) -> DataFrame:
    """Precision, recall, F1, hit rate and reciprocal rank of every query that has relevant documents.

    ``run(query_id, doc_id, position)`` in list order, ``qrels(query_id, doc_id)`` the relevant ones.
    """
    wanted = qrels.select("query_id", "doc_id", F.lit(1).alias("_rel")).distinct()
    judged = run.groupBy("query_id", "doc_id").agg(F.min("position").alias("position")).join(wanted, ["query_id", "doc_id"], "left")
    found = judged.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("_n"), F.count("_rel").alias("_hits"), F.min(F.when(F.col("_rel") == 1, F.col("position"))).alias("_first")
    )
    sizes = wanted.groupBy("query_id").agg(F.count(F.lit(1)).alias("_relevant"))
    joined = sizes.join(found, "query_id", "left").na.fill(0, ["_n", "_hits"])
    precision = F.when(F.col("_n") > 0, F.col("_hits") / F.col("_n")).otherwise(0.0)
    recall = F.col("_hits") / F.col("_relevant")
    both = precision + recall
    return joined.select(
        "query_id",
        precision.alias("precision"),
        recall.alias("recall"),
        F.when(both > 0, 2 * precision * recall / both).otherwise(0.0).alias("f1"),
        F.when(F.col("_hits") > 0, 1.0).otherwise(0.0).alias("hit_rate"),
        F.coalesce(1.0 / F.col("_first"), F.lit(0.0)).alias("mrr"),
    )


def ranked_metrics(run: DataFrame, qrels: DataFrame, ndcg_at: int = 10, map_at: int = 5, mrr_at: int = 10) -> DataFrame:
    """Per query normalised gain, average precision and reciprocal rank at their cuts, worst gain first by value.

    ``run(query_id, doc_id, score)``, ``qrels(query_id, doc_id, rel)``.
    """
    deepest = max(ndcg_at, map_at, mrr_at)
    order = Window.partitionBy("query_id").orderBy(F.round("score", 6).desc(), "doc_id")
    top = run.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= deepest)
    judged = top.join(qrels.select("query_id", "doc_id", "rel"), ["query_id", "doc_id"], "left").na.fill(0, ["rel"])
    hit = (F.col("rel") > 0).cast("int")
    upto = Window.partitionBy("query_id").orderBy("rank")
    scored = judged.withColumn("_hits", F.sum(hit).over(upto))
    gain = lambda rel, rank: rel / F.log2(rank + 1)
    sums = scored.groupBy("query_id").agg(
        F.sum(F.when(F.col("rank") <= ndcg_at, gain(F.col("rel"), F.col("rank"))).otherwise(0.0)).alias("_dcg"),
        F.sum(F.when((F.col("rank") <= map_at) & (F.col("rel") > 0), F.col("_hits") / F.col("rank")).otherwise(0.0)).alias("_ap"),
        F.max(F.when((F.col("rank") <= mrr_at) & (F.col("rel") > 0), 1.0 / F.col("rank")).otherwise(0.0)).alias("mrr"),
    )
    best = Window.partitionBy("query_id").orderBy(F.col("rel").desc(), "doc_id")
    relevant = qrels.filter("rel > 0")
    ideal = (
        relevant.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= ndcg_at)
        .groupBy("query_id")
        .agg(F.sum(gain(F.col("rel"), F.col("rank"))).alias("_ideal"))
    )
    sizes = relevant.groupBy("query_id").agg(F.count(F.lit(1)).alias("_relevant"))
    return (
        ideal.join(sizes, "query_id")
        .join(sums, "query_id", "left")
        .na.fill(0.0, ["_dcg", "_ap", "mrr"])
        .select(
            "query_id",
            (F.col("_dcg") / F.col("_ideal")).alias("ndcg"),
            (F.col("_ap") / F.col("_relevant")).alias("map"),
            "mrr",
        )
    )


def mean_metrics(metrics: DataFrame, names: Sequence[str] = ("ndcg", "map", "mrr")) -> DataFrame:
    """One row: number of queries and the mean of each metric."""
    return metrics.agg(F.count(F.lit(1)).alias("queries"), *[F.avg(n).alias(n) for n in names])


def worst_first(metrics: DataFrame, by: str = "ndcg") -> DataFrame:
    """Queries with their place in the report, the worst first; equal ones by query."""
    return scans.ranked(metrics, [], [F.round(by, 6), F.col("query_id")], "place")


def qrels_from_table(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Corpus and relevance rows of ``(query_id, passages array<string>, selected array<int>)``.

    Queries without any selected passage are dropped from the relevance table.
    """
    pairs = rows.select("query_id", F.explode(F.arrays_zip("passages", "selected")).alias("p")).select(
        "query_id", F.md5("p.passages").alias("doc_id"), F.col("p.passages").alias("text"), F.col("p.selected").alias("rel")
    )
    corpus = pairs.select("doc_id", "text").dropDuplicates(["doc_id"])
    qrels = pairs.groupBy("query_id", "doc_id").agg(F.max("rel").alias("rel"))
    chosen = qrels.filter("rel > 0").select("query_id").distinct()
    return corpus, qrels.join(chosen, "query_id", "left_semi")


def answer_metrics(answers: DataFrame, answer: str = "answer") -> DataFrame:
    """Length of each non-empty answer and whether it says anything."""
    return answers.filter(F.coalesce(F.col(answer), F.lit("")) != "").withColumns(
        {"answer_length": F.length(answer), "has_answer": F.when(F.col(answer).rlike(r"\S"), 1.0).otherwise(0.0)}
    )


def compare_runs(
    first: DataFrame, second: DataFrame, key: str, exact: Sequence[str], close: Sequence[str] = (), tolerance: float = 1e-6
) -> DataFrame:
    """Rows of two outputs that differ or are on one side only, with the columns that differ.

    ``exact`` columns must be equal (nulls are), ``close`` ones within the tolerance; other columns are ignored.
    """
    a = first.select(key, *[F.col(c).alias(f"a_{c}") for c in (*exact, *close)], F.lit(True).alias("_a"))
    b = second.select(key, *[F.col(c).alias(f"b_{c}") for c in (*exact, *close)], F.lit(True).alias("_b"))
    differs = [F.when(~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")), F.lit(c)) for c in exact]
    differs += [
        F.when(
            F.col(f"a_{c}").isNull() != F.col(f"b_{c}").isNull(), F.lit(c)
        ).when(F.abs(F.col(f"a_{c}") - F.col(f"b_{c}")) > tolerance, F.lit(c))
        for c in close
    ]
    columns = F.array_join(F.array_compact(F.array(*differs)), ",")
    status = F.when(F.col("_b").isNull(), "first only").when(F.col("_a").isNull(), "second only").when(columns != "", "differs")
    return (
        a.join(b, key, "full")
        .select(key, status.alias("status"), F.when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), columns).alias("columns"))
        .filter(F.col("status").isNotNull())
    )
