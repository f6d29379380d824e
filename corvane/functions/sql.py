"""The engine's functions for SQL text: ``register(session)`` makes them known to ``spark.sql``.

``words``, ``token_match``, ``cosine`` and ``term_weight`` are SQL functions, which the optimizer inlines like any other
expression; ``cosine_batch`` computes whole Arrow batches with numpy; ``split_chunks`` is a table function for
``FROM docs, LATERAL split_chunks(text, 128, 20)``.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corvane.functions import text as tx
from corvane.operators import terms

DEFINITIONS = (
    rf"""words(text STRING) RETURNS ARRAY<STRING> RETURN regexp_extract_all(lower(text), r'{tx.WORD}', 0)""",
    """token_match(tokens ARRAY<STRING>, text STRING, share DOUBLE DEFAULT 0.3D) RETURNS BOOLEAN RETURN
      size(array_intersect(array_distinct(words(text)), tokens)) >= greatest(1, CAST(floor(size(array_distinct(words(text))) * share) AS INT))""",
    """dot(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>) RETURNS DOUBLE RETURN aggregate(zip_with(a, b, (x, y) -> x * y), 0D, (s, x) -> s + x)""",
    """cosine(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>) RETURNS DOUBLE RETURN
      CASE WHEN size(a) = size(b) AND dot(a, a) * dot(b, b) > 0 THEN dot(a, b) / (sqrt(dot(a, a)) * sqrt(dot(b, b))) ELSE 0D END""",
    # the count a term is weighed by: a fixed one for groups of numbers, an assumed one where the corpus lacks it
    rf"""assumed_count(token STRING, seen BIGINT, more BIGINT, numbers DOUBLE, least DOUBLE) RETURNS DOUBLE RETURN
      CASE WHEN token RLIKE r'{terms.NUMBER_GROUP}' THEN numbers
        ELSE greatest(least, coalesce(CAST(seen + more AS DOUBLE), CASE WHEN token RLIKE r'{terms.LETTERS}' THEN 300D END, least)) END""",
    f"""term_weight(token STRING, tf BIGINT, df BIGINT) RETURNS DOUBLE RETURN
      (0.3D * log10(10 + ({terms.FREQUENCY_TOTAL} - assumed_count(token, tf, 0, 3, 10) + 0.5D) / (assumed_count(token, tf, 0, 3, 10) + 0.5D))
        + 0.7D * log10(10 + ({terms.DOCUMENT_TOTAL} - assumed_count(token, df, 3, 5, 3) + 0.5D) / (assumed_count(token, df, 3, 5, 3) + 0.5D)))
      * CASE WHEN token RLIKE r'{terms.NUMBER}' THEN 2D WHEN token RLIKE r'{terms.SHORT_WORD}' THEN 0.01D ELSE 1D END
      * CASE WHEN token RLIKE r'{terms.LEADING_DIGIT}' THEN 2D ELSE 1D END""",
)
TOKEN = re.compile(r"\w+|[^\w \t\n\x0b\f\r]")


def cosine_batch(first: pd.Series, second: pd.Series) -> pd.Series:
    """Cosine of the vectors of two columns, a whole batch at once; 0 for a zero vector or unequal lengths."""
    out = np.zeros(len(first))
    sizes = np.array([(len(a) if a is not None else -1, len(b) if b is not None else -2) for a, b in zip(first, second)]).reshape(-1, 2)
    for size in np.unique(sizes[sizes[:, 0] == sizes[:, 1], 0]):
        rows = np.flatnonzero((sizes == size).all(axis=1))
        a, b = (np.array([s.iloc[i] for i in rows], dtype=np.float64).reshape(len(rows), size) for s in (first, second))
        length = np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1)
        out[rows] = np.divide((a * b).sum(axis=1), length, out=np.zeros(len(rows)), where=length > 0)
    return pd.Series(out)


class SplitChunks:
    """Lines of a text merged greedily, as ``chunk_by_tokens`` does; one row ``chunk, content`` for each chunk."""

    def eval(self, text: str, size: int, overlap: int):
        if text is None:
            return
        limit, held, total, chunk, last = size * (100 - overlap) / 100.0, [], 0, 0, ""

        def close() -> str:
            return last[int(len(last) * (100 - overlap) / 100.0) :] + "".join(held) if overlap else "".join(held)

        for line in text.split("\n"):
            if held and total > limit:
                last = close()
                yield chunk, last
                chunk, held, total = chunk + 1, [], 0
            held.append("\n" + line)
            total += len(TOKEN.findall(line))
        yield chunk, close()


def register(spark: SparkSession) -> SparkSession:
    """Make the functions known to the session; may be called again."""
    for text in DEFINITIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {text}")
    spark.udf.register("cosine_batch", F.pandas_udf(cosine_batch, "double"))
    spark.udtf.register("split_chunks", F.udtf(SplitChunks, returnType="chunk int, content string", useArrow=True))
    return spark
