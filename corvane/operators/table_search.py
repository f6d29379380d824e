"""SQL text over the rows of a dataset."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from corvane.functions import sql as sql_functions

FENCE = re.compile(r"^\s*```(?:sql)?\s*|\s*```\s*$", re.IGNORECASE)
AGGREGATE = re.compile(r"\b(count|sum|avg|max|min|distinct)\s*\(|\bgroup\s+by\b", re.IGNORECASE)


def plain_sql(text: str) -> str:
    """SQL text without code fences, closing semicolons and needless blanks."""
    return FENCE.sub("", text).strip().rstrip(";").strip()


def match_tokens(text: str, token_columns: Sequence[str], share: float = 0.3) -> str:
    """Equality and LIKE of a token column with a text become a match of ``share`` of the text's words."""
    if not token_columns:
        return text
    names = "|".join(re.escape(c) for c in sorted(token_columns, key=len, reverse=True))
    equality = re.compile(rf"(?<![\w.`])((?:\w+\.)?(?:{names}))\s*(?:=|\blike\b)\s*('(?:[^']|'')*')", re.IGNORECASE)
    return equality.sub(lambda m: f"token_match({m[1]}, {m[2].replace('%', '')}, {share}D)", text)


def table_search(
    rows: DataFrame,
    text: str,
    scope: Column | None = None,
    token_columns: Sequence[str] = (),
    source_columns: Sequence[str] = (),
    name: str = "rows",
) -> DataFrame:
    """Result of the SQL ``text``, in which ``name`` stands for the rows of ``scope`` and nothing else of the table.

    The scope holds whatever the text says, as it is applied below it. The columns of ``token_columns`` hold words and
    are compared by ``match_tokens``. A result that is no aggregate must have all ``source_columns``, so that answers
    can name where they come from; else ``ValueError``.
    """
    spark = sql_functions.register(rows.sparkSession)
    wanted = match_tokens(plain_sql(text), token_columns)
    view = f"scope_{uuid.uuid4().hex}"
    (rows if scope is None else rows.filter(scope)).createOrReplaceTempView(view)
    try:
        found = spark.sql(re.sub(rf"(?<![\w.`'])\b{re.escape(name)}\b(?!\s*\()(?=[^']*(?:'[^']*'[^']*)*$)", view, wanted))
    finally:
        spark.catalog.dropTempView(view)
    lacking = [c for c in source_columns if c not in found.columns]
    if lacking and not AGGREGATE.search(wanted):
        raise ValueError(f"the result does not carry its sources: {', '.join(lacking)}")
    return found
