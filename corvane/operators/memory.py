"""Conversation memory: storing with a size limit, missing fields, fitting a conversation into a budget."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.functions import text as tx
from corvane.operators import aggregates, ordering


def remember(raw: DataFrame, extracted: DataFrame, capacity: int) -> DataFrame:
    """Raw and extracted messages of each memory that remain under ``capacity`` bytes.

    A memory over its capacity forgets first in, first out until the excess is gone.
    Input ``memory_id, message_id, content, valid_at`` and, for raw messages, ``forget_at``.
    """
    columns = ["memory_id", "message_id", "content", "valid_at", "forget_at", "kind"]
    rows = (
        raw.withColumn("kind", F.lit("raw")).select(*columns)
        .unionByName(
            extracted.withColumns({"kind": F.lit("fact"), "forget_at": F.lit(None).cast(raw.schema["forget_at"].dataType)}).select(*columns)
        )
        .withColumn("size", aggregates.message_size(F.col("content")))
    )
    totals = rows.groupBy("memory_id").agg((F.sum("size") - capacity).alias("_excess"))
    staged = ordering.fifo_evict(rows, 2**62).join(totals, "memory_id")
    return staged.filter(F.col("freed_before") >= F.col("_excess")).drop("_excess", "freed_before")


def fill_missing(messages: DataFrame, field: str) -> DataFrame:
    """Messages that lack a field."""
    return messages.filter(F.col(field).isNull())


def conversation_fit(messages: DataFrame, max_tokens: int) -> DataFrame:
    """Messages of each conversation that fit the budget, trimmed where needed.

    A conversation under the budget stays whole. Otherwise its system messages and its last message stay; when they
    are still too long, the first and the last of them are cut: a first one that holds over 80 % of the pair gives
    way to the last, otherwise the last gives way. Input ``memory_id, turn, role, content``.
    """
    counted = messages.withColumn("tokens", tx.token_count("content"))
    sums = counted.groupBy("memory_id").agg(
        F.sum("tokens").alias("_all"),
        F.max("turn").alias("_last"),
        F.coalesce(F.min(F.when(F.col("role") == "system", F.col("turn"))), F.max("turn")).alias("_first"),
    )
    core = counted.join(sums, "memory_id").withColumn(
        "_core", (F.col("role") == "system") | (F.col("turn") == F.col("_last"))
    )
    lengths = (
        core.filter("_core")
        .groupBy("memory_id")
        .agg(
            F.sum("tokens").alias("_kept"),
            F.max(F.when(F.col("turn") == F.col("_first"), F.col("tokens"))).alias("_head"),
            F.max(F.when(F.col("turn") == F.col("_last"), F.col("tokens"))).alias("_tail"),
        )
    )
    limit = F.lit(max_tokens)
    pair = F.col("_head") + F.col("_tail")
    tail_first = F.col("_head") / pair > 0.8
    keep_tail = F.when(tail_first, F.least("_tail", limit)).otherwise(limit - F.least("_head", limit))
    keep_head = F.when(tail_first, limit - F.least("_tail", limit)).otherwise(F.least("_head", limit))
    fits = F.col("_kept") < limit
    alone = F.col("_first") == F.col("_last")
    cut = (
        F.when((F.col("_all") < limit) | fits, None)
        .when(alone, limit)
        .when(F.col("turn") == F.col("_first"), keep_head)
        .when(F.col("turn") == F.col("_last"), keep_tail)
    )
    fitted = core.join(lengths, "memory_id").filter((F.col("_all") < limit) | F.col("_core")).withColumn("_cut", cut)
    text = F.when(
        F.col("_cut").isNotNull() & (F.col("_cut") < F.col("tokens")), tx.truncate_tokens("content", F.col("_cut").cast("int"))
    ).otherwise(F.col("content"))
    return fitted.select("memory_id", "turn", "role", text.alias("content"))
