"""Tables the queries derive from the given ones, each with the SQL that derives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import text as tx
from corvane.plans.registry import table

# Word tokens in the twins.
SQL_WORDS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]+')"
SQL_TOKENS = r"len(regexp_extract_all({0}, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s]'))"


def sql_words(column: str) -> str:
    return SQL_WORDS.format(column)


def sql_token_count(column: str) -> str:
    return SQL_TOKENS.format(column)


LINES_SQL = """lines AS (
  SELECT doc_id, lang, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS ord
  FROM documents)"""

CHUNKS_SQL = (
    LINES_SQL
    + """,
chunks AS (
  SELECT md5(doc_id || ':' || ord) AS chunk_id, doc_id, lang, source, ord, line AS content
  FROM lines WHERE regexp_matches(line, '\\S'))"""
)

META_SQL = """meta AS (
  SELECT doc_id, 'lang' AS key, lang AS value FROM documents
  UNION ALL SELECT doc_id, 'source', source FROM documents
  UNION ALL SELECT doc_id, 'tag', lang FROM documents
  UNION ALL SELECT doc_id, 'tag', source FROM documents
  UNION ALL SELECT doc_id, 'size', CAST(n_chars AS VARCHAR) FROM documents
  UNION ALL SELECT doc_id, 'quality', CAST(quality AS VARCHAR) FROM labels
  UNION ALL SELECT doc_id, 'toxic', CAST(toxic AS VARCHAR) FROM labels)"""

MESSAGES_SQL = """messages AS (
  SELECT conv_id || ':' || turn AS message_id, conv_id AS memory_id, turn, role, text AS content,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(conv_id * 10 + turn AS BIGINT)) AS valid_at,
         CASE WHEN conv_id % 7 = 0 THEN TIMESTAMP '2024-06-01 00:00:00' + to_minutes(CAST(turn AS BIGINT)) END AS forget_at
  FROM conversations)"""


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of every document with its 0-based position."""
    return table(spark, folder, "documents").select(
        "doc_id", "lang", "source", F.posexplode(F.split("text", "\n")).alias("ord", "line")
    )


def chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Non-blank document lines as chunks."""
    return (
        lines(spark, folder)
        .filter(F.col("line").rlike(r"\S"))
        .select(
            F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.col("ord").cast("string"))).alias("chunk_id"),
            "doc_id",
            "lang",
            "source",
            F.col("ord").cast("bigint").alias("ord"),
            F.col("line").alias("content"),
        )
    )


def questions(spark: SparkSession, folder: str) -> DataFrame:
    """The question set."""
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Long metadata ``(doc_id, key, value)``; ``tag`` holds two values per document."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, folder, "labels")
    entries = lambda *pairs: F.explode(
        F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in pairs])
    ).alias("e")
    from_docs = docs.select(
        "doc_id",
        entries(
            ("lang", F.col("lang")),
            ("source", F.col("source")),
            ("tag", F.col("lang")),
            ("tag", F.col("source")),
            ("size", F.col("n_chars")),
        ),
    )
    from_labels = labels.select("doc_id", entries(("quality", F.col("quality")), ("toxic", F.col("toxic"))))
    return from_docs.unionByName(from_labels).select("doc_id", "e.key", "e.value")


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as memory messages with a validity time; every seventh conversation is forgotten."""
    minutes = lambda c: F.make_dt_interval(mins=c.cast("int"))
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    forgotten = F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")
    return table(spark, folder, "conversations").select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("message_id"),
        F.col("conv_id").alias("memory_id"),
        "turn",
        "role",
        F.col("text").alias("content"),
        (start + minutes(F.col("conv_id") * 10 + F.col("turn"))).alias("valid_at"),
        F.when(F.col("conv_id") % 7 == 0, forgotten + minutes(F.col("turn"))).alias("forget_at"),
    )
