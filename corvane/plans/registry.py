"""Registered queries: a Spark plan per name and, where SQL can say the same, its twin for the check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.session import spread

PLANS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}


# Tables of long texts, by the key their rows are spread over when the file has too few splits.
TEXT_KEYS = {"documents": "doc_id", "pages": "page_id"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    rows = spark.read.parquet(f"{folder}/{name}.parquet")
    return spread(rows, TEXT_KEYS[name]) if name in TEXT_KEYS else rows


def plain(df: DataFrame) -> DataFrame:
    """Result form shared by all queries: 64-bit integers, doubles rounded to six places."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("bigint")
        elif isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            column = F.round(column.cast("double"), 6) + F.lit(0.0)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None):
    """Register a plan under ``name``; ``sql`` is the same query for the check."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if name in PLANS:
            raise ValueError(f"query {name} is registered twice")
        PLANS[name] = lambda spark, folder: plain(fn(spark, folder))
        if sql is not None:
            TWINS[name] = sql.strip()
        return fn

    return register
