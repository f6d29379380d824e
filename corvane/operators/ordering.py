"""Sorting, paging, top-k, record lists, and running budgets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.operators import scans
from corvane.operators.scans import ordinal, running_total


def order_by(df: DataFrame, keys: Sequence[tuple[str, str]]) -> DataFrame:
    """Multi-key order; a column the table lacks is skipped, nulls go last."""
    columns = [
        F.col(name).desc_nulls_last() if direction == "desc" else F.col(name).asc_nulls_last()
        for name, direction in keys
        if name in df.columns
    ]
    return df.orderBy(*columns) if columns else df


def page(df: DataFrame, number: int, size: int) -> DataFrame:
    """Page ``number`` (from 1) of an ordered table."""
    return df.offset((number - 1) * size).limit(size)


def keyset_page(df: DataFrame, keys: Sequence[str], after: Sequence | None, size: int) -> DataFrame:
    """The next ``size`` rows after the sort tuple of the last row seen; cost does not grow with the depth."""
    if after is not None:
        later, same = F.lit(False), F.lit(True)
        for name, value in zip(keys, after):
            later = later | (same & (F.col(name) > F.lit(value)))
            same = same & (F.col(name) == F.lit(value))
        df = df.filter(later)
    return df.orderBy(*keys).limit(size)


def topk_per_query(df: DataFrame, k: int, score: str = "score", tie: str = "chunk_id", key: str = "query_id") -> DataFrame:
    """Best ``k`` rows per query with their rank; partial top-k runs before the shuffle.

    Scores equal to six places count as ties, so that the order does not hang on the order of additions.
    """
    window = Window.partitionBy(key).orderBy(F.round(score, 6).desc(), F.col(tie))
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def rank_hits(hits: DataFrame, candidates: int | None = None) -> DataFrame:
    """Descending stable rank per query over its candidate window, or over all of its hits, however many."""
    if candidates is not None:
        return topk_per_query(hits, candidates)
    return scans.ranked(hits, ["query_id"], [F.round("score", 6).desc(), F.col("chunk_id")])


def nth(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """The ``n``-th record, counted from 1, or from the end when negative."""
    if n == 0:
        raise ValueError("n counts from 1 or from -1")
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    ordered = df.orderBy(*[c.asc() for c in columns]) if n > 0 else df.orderBy(*[c.desc() for c in columns])
    return ordered.offset(abs(n) - 1).limit(1)


def head(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` records."""
    if n < 0:
        raise ValueError("n must not be negative")
    return df.orderBy(*order).limit(n)


def tail(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The last ``n`` records."""
    if n < 0:
        raise ValueError("n must not be negative")
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def drop_duplicates(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The first record of each key by ``order``; combines on the map side."""
    others = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*others), F.col(order)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, "_first.*")


def positional_order(positions: Column, page_no: Column, top: Column) -> list[Column]:
    """Sort keys for reading order: page, top edge, left edge; array keys sort by their mean, missing ones last."""
    mean = lambda a: F.when(F.size(a) > 0, F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double")) / F.size(a))
    left = F.try_element_at(F.try_element_at(positions, F.lit(1)), F.lit(2))
    return [mean(page_no).asc_nulls_last(), mean(top).asc_nulls_last(), left.asc_nulls_last()]


def fit_context(hits: DataFrame, max_tokens: int, share: float = 0.97) -> DataFrame:
    """Hits per query, in rank order, until the token sum passes the share of the budget; the crossing hit stays.

    Blank hits are dropped first. Hits are top-k lists, so a query's rows are few.
    """
    before = Window.partitionBy("query_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    kept = hits.filter(F.col("tokens") > 0).withColumn("_before", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    return kept.filter(F.col("_before") <= max_tokens * share).drop("_before")


def fit_memory(messages: DataFrame, max_tokens: int, share: float = 0.97) -> DataFrame:
    """Leading messages of each memory whose token sum stays within the share of the budget; the crossing one is out."""
    total = running_total(
        messages.withColumn("_bucket", F.floor(F.col("turn") / 4096)),
        ["memory_id"],
        ["_bucket"],
        ["turn"],
        "tokens",
        "_upto",
    )
    return total.filter(F.col("_upto") <= max_tokens * share).drop("_bucket", "_upto")


def fifo_evict(messages: DataFrame, need: int) -> DataFrame:
    """Messages of each memory to delete until ``need`` bytes are free.

    Forgotten ones go first by the time they were forgotten, then the oldest; the message that reaches the need
    is taken. Input ``memory_id, message_id, valid_at, forget_at, size``.
    """
    staged = messages.withColumns(
        {
            "_class": F.col("forget_at").isNull().cast("int"),
            "_time": F.coalesce("forget_at", "valid_at"),
        }
    ).withColumn("_day", F.to_date("_time"))
    total = running_total(
        staged, ["memory_id"], ["_class", "_day"], ["_time", "message_id"], "size", "freed_before", exclusive=True
    )
    return total.filter(F.col("freed_before") < need).drop("_class", "_time", "_day")


def fit_graph_context(entities: DataFrame, relations: DataFrame, max_tokens: int) -> DataFrame:
    """Entities, then relations, that share one token budget per query; a list stops at the item that uses it up.

    Both inputs are ranked top-k lists ``(query_id, rank, item, tokens)``.
    """
    items = entities.withColumn("kind", F.lit(0)).unionByName(relations.withColumn("kind", F.lit(1)))
    inside = Window.partitionBy("query_id", "kind").orderBy("rank")
    summed = items.withColumn("_upto", F.sum("tokens").over(inside))
    used = (
        summed.filter((F.col("kind") == 0))
        .groupBy("query_id")
        .agg(
            F.max(F.when(F.col("_upto") < max_tokens, F.col("_upto"))).alias("_kept"),
            F.min(F.when(F.col("_upto") >= max_tokens, F.col("_upto"))).alias("_over"),
        )
    )
    left = F.lit(max_tokens) - F.when(F.col("kind") == 1, F.coalesce("_over", "_kept", F.lit(0))).otherwise(F.lit(0))
    return summed.join(used, "query_id", "left").filter(F.col("_upto") < left).drop("_upto", "_kept", "_over")


def section_ids(lines: DataFrame, target: str = "target") -> DataFrame:
    """Section counter per document: a line at or above the target level starts a section, except the first line.

    Input ``doc_id, ord, level`` and the target level column.
    """
    starts = lines.withColumns(
        {
            "_bucket": F.floor(F.col("ord") / 4096),
            "_start": ((F.col("level") <= F.col(target)) & (F.col("ord") > 0)).cast("bigint"),
        }
    )
    return running_total(starts, ["doc_id"], ["_bucket"], ["ord"], "_start", "section").drop("_bucket", "_start")


def bigrams(tokens: Column) -> Column:
    """Adjacent token pairs, joined by a blank."""
    return F.when(
        F.size(tokens) > 1,
        F.zip_with(
            F.slice(tokens, F.lit(1), F.size(tokens) - 1), F.slice(tokens, F.lit(2), F.size(tokens) - 1), lambda a, b: F.concat_ws(" ", a, b)
        ),
    ).otherwise(F.array().cast("array<string>"))


def recent_messages(messages: DataFrame, limit: int) -> DataFrame:
    """The latest ``limit`` messages of each memory."""
    window = Window.partitionBy("memory_id").orderBy(F.col("valid_at").desc(), F.col("message_id"))
    return messages.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= limit)


def number_rows(df: DataFrame, order: str, width: int = 10_000) -> DataFrame:
    """0-based position of every row in the whole table, by an integer order column, without a single-task sort."""
    staged = df.withColumns({"_all": F.lit(0), "_bucket": F.floor(F.col(order) / width)})
    placed = ordinal(staged, ["_all"], ["_bucket"], [order], "_place")
    return placed.withColumn("position", F.col("_place") - 1).drop("_all", "_bucket", "_place")
