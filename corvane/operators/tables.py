"""Table rows and line files to chunks: pairs, tags, typed columns, batches, index columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import scalars as sc
from corvane.functions import text as tx
from corvane.operators import scans
from corvane.operators.scans import running_total

# Key columns left out of row chunks, cell patterns of each type, and the order that settles ties.
KEY_COLUMNS = ("id", "_id", "index", "idx")
TYPE_ORDER = ("int", "float", "text", "datetime", "bool")
BOOL_CELL = r"(?i)^(true|yes|是|\*|✓|✔|☑|✅|√|false|no|否|⍻|×)$"


def line_delimiter(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """The delimiter of each file: tab when at least as many lines have two tab columns as two comma columns."""
    two = lambda d: F.sum((F.size(F.split("line", d)) == 2).cast("int"))
    return lines.groupBy(key).agg(F.when(two("\t") >= two(","), "\t").otherwise(",").alias("delimiter"))


def _columns(lines: DataFrame, key: str) -> DataFrame:
    parts = F.when(F.col("delimiter") == "\t", F.split("line", "\t")).otherwise(F.split("line", ","))
    return lines.join(line_delimiter(lines, key), key).withColumns(
        {"parts": parts, "pair": (F.size(parts) == 2).cast("bigint"), "_bucket": F.floor(F.col("ord") / 4096)}
    )


def qa_pairs(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """Question/answer pairs of two-column files; other lines extend the current answer.

    Pairs without a question are dropped, and so are pairs without an answer unless they are the file's last.
    Input ``key, ord, line``.
    """
    marked = running_total(_columns(lines, key), [key], ["_bucket"], ["ord"], "pair", "item").filter("item > 0")
    first = F.col("pair") == 1
    joined = marked.groupBy(key, "item").agg(
        F.max(F.when(first, F.element_at("parts", 1))).alias("question"),
        F.max(F.when(first, F.element_at("parts", 2))).alias("_answer"),
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.when(~first, F.struct("ord", "line")))), lambda e: F.concat(F.lit("\n"), e["line"])), ""
        ).alias("_more"),
    )
    last = joined.groupBy(key).agg(F.max("item").alias("_last"))
    return (
        joined.withColumn("answer", F.concat("_answer", "_more"))
        .join(last, key)
        .filter((F.col("question") != "") & ((F.col("answer") != "") | (F.col("item") == F.col("_last"))))
        .select(key, "item", "question", "answer")
    )


def markdown_qa(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """Markdown headings as questions: each body belongs to the stack of headings above it.

    Input ``key, ord, line``; output the heading's order, its question path and the answer.
    """
    level = F.length(F.regexp_extract("line", r"^(#{1,6})\s", 1))
    marked = running_total(
        lines.withColumns({"level": level, "head": (level > 0).cast("bigint"), "_bucket": F.floor(F.col("ord") / 4096)}),
        [key], ["_bucket"], ["ord"], "head", "item",
    ).filter("item > 0")
    heads = marked.filter("level > 0").groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("item", "level", F.regexp_replace("line", r"^#{1,6}\s+", "").alias("title")))).alias("heads")
    )
    bodies = (
        marked.filter("level = 0 AND trim(line) <> ''")
        .groupBy(key, "item")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "line"))), lambda e: e["line"]), "\n").alias("answer"))
    )
    own = F.element_at(F.filter("heads", lambda h: h["item"] == F.col("item")), 1)
    start = F.struct(own["level"].alias("level"), F.array(own["title"]).alias("path"))
    above = F.aggregate(
        F.reverse(F.filter("heads", lambda h: h["item"] < F.col("item"))),
        start,
        lambda acc, h: F.when(
            h["level"] < acc["level"], F.struct(h["level"].alias("level"), F.concat(F.array(h["title"]), acc["path"]).alias("path"))
        ).otherwise(acc),
        lambda acc: acc["path"],
    )
    return bodies.join(heads, key).select(key, "item", F.array_join(above, "\n").alias("question"), "answer")


def tag_pairs(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """Text accumulates until a two-column line closes it with its tags; an unclosed rest is dropped."""
    marked = running_total(
        _columns(lines, key), [key], ["_bucket"], ["ord"], "pair", "item", exclusive=True
    )
    shown = F.when(F.col("pair") == 1, F.element_at("parts", 1)).otherwise(F.col("line"))
    return (
        marked.groupBy(key, "item")
        .agg(
            F.array_join(
                F.transform(F.array_sort(F.collect_list(F.struct("ord", shown.alias("s")))), lambda e: F.concat(F.lit("\n"), e["s"])), ""
            ).alias("content"),
            F.max(F.when(F.col("pair") == 1, F.element_at("parts", 2))).alias("tags"),
        )
        .filter(F.col("tags").isNotNull())
        .withColumn("tags", F.filter(F.transform(F.split("tags", ","), lambda t: F.replace(F.trim(t), F.lit("."), F.lit("_"))), lambda t: t != ""))
    )


def table_rows_to_chunks(rows: DataFrame, roles: Mapping[str, str] | None = None) -> DataFrame:
    """One chunk per row: ``- column: value`` lines of the indexed columns, and the columns kept as metadata.

    A column's role is ``indexing``, ``metadata`` or ``both`` (the default). Key columns are dropped.
    """
    names = [c for c in rows.columns if c not in KEY_COLUMNS]
    if len(set(names)) != len(names):
        raise ValueError(f"duplicate column names: {names}")
    role = lambda c: (roles or {}).get(c, "both")
    line = lambda c: F.when(
        F.col(c).isNotNull() & (F.col(c).cast("string") != ""), F.concat(F.lit(f"- {c}: "), F.col(c).cast("string"))
    )
    content = F.concat_ws("\n", *[line(c) for c in names if role(c) in ("indexing", "both")])
    return rows.select(content.alias("content"), *[F.col(c) for c in names if role(c) in ("metadata", "both")])


def cell_class(value: Column) -> Column:
    """Type class of one cell; numbers with a leading zero are text (so ``0.5`` is no float)."""
    plain = F.replace(value, F.lit("%%"), F.lit(""))
    zero = F.startswith(plain, F.lit("0"))
    return (
        F.when(plain.rlike(r"^[+-]?[0-9]+$") & ~zero, "int")
        .when(plain.rlike(r"^[+-]?[0-9.]{0,19}$") & ~zero, "float")
        .when(value.rlike(BOOL_CELL), "bool")
        .when(value.try_cast("timestamp_ntz").isNotNull() & value.rlike(r"\d{4}-\d{1,2}"), "datetime")
        .otherwise("text")
    )


def infer_column_types(rows: DataFrame) -> DataFrame:
    """Majority type of each column ``(column, type)``; an integer beyond 64 bits makes the column float."""
    long = rows.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in rows.columns])).alias("e")
    ).select("e.*").filter(F.col("value").isNotNull())
    kind = cell_class(F.col("value"))
    beyond = (kind == "int") & (F.col("value").try_cast("decimal(38,0)") > F.lit(2**63 - 1))
    counts = long.groupBy("column", kind.alias("type")).agg(F.count(F.lit(1)).alias("_n"), F.max(beyond).alias("_beyond"))
    place = F.array_position(F.array(*[F.lit(t) for t in TYPE_ORDER]), F.col("type"))
    return counts.groupBy("column").agg(
        F.when(F.max("_beyond"), "float").otherwise(F.min_by("type", F.struct(-F.col("_n"), place))).alias("type")
    )


def cast_columns(rows: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Columns as their inferred types; cells that do not fit become null."""
    return rows.select(*[sc.typed_cell(F.col(c), types[c]).alias(c) if c in types else F.col(c) for c in rows.columns])


def position_columns(df: DataFrame, boxes: str = "boxes") -> DataFrame:
    """Page, box and top-edge arrays of ``boxes array<struct<page, left, right, top, bottom>>``; pages count from 1."""
    return df.withColumns(
        {
            "page_no": F.transform(boxes, lambda b: (b["page"] + 1).cast("int")),
            "pos": F.transform(
                boxes,
                lambda b: F.array(*[x.cast("int") for x in (b["page"] + 1, b["left"], b["right"], b["top"], b["bottom"])]),
            ),
            "top_edge": F.transform(boxes, lambda b: b["top"].cast("int")),
        }
    ).drop(boxes)


def index_columns(chunks: DataFrame) -> DataFrame:
    """Columns a chunk is searched by: token columns, question and keyword lists; a summary replaces the text.

    Input ``content`` and optional ``title, summary, questions, keywords`` text columns.
    """
    has = lambda c: F.col(c) if c in chunks.columns else F.lit(None).cast("string")
    body = F.coalesce(F.nullif(has("summary"), F.lit("")), F.col("content"))
    questions = F.filter(F.split(F.coalesce(has("questions"), F.lit("")), "\n"), lambda q: q != "")
    keywords = F.filter(F.split(F.coalesce(has("keywords"), F.lit("")), ","), lambda k: k != "")
    return chunks.withColumns(
        {
            "tokens": tx.words(tx.strip_table_tags(body)),
            "fine_tokens": tx.fine_words(tx.strip_table_tags(body)),
            "title_tokens": tx.words(F.regexp_replace(F.coalesce(has("title"), F.lit("")), r"\.[a-zA-Z]+$", "")),
            "question_list": questions,
            "question_tokens": tx.words(F.array_join(questions, "\n")),
            "important": keywords,
            "important_tokens": tx.words(F.array_join(keywords, " ")),
        }
    )


def batch_table_rows(rows: DataFrame, order: str, line: str, n: int = 10, separator: str = "; ") -> DataFrame:
    """``n`` table rows per chunk, in the order of a column, over the whole table."""
    placed = scans.ranked(rows.select(order, line), [], [order], "_place").withColumn("position", F.col("_place") - 1)
    return placed.groupBy(F.floor(F.col("position") / n).alias("chunk")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", F.col(line).alias("s")))), lambda e: e["s"]), separator).alias("content")
    )
