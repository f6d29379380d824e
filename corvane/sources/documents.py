"""Rows, API payloads, feeds and delimited files to documents."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import scalars as sc


def _shown(df: DataFrame, name: str) -> Column:
    kind = dict(df.dtypes)[name]
    return F.to_json(name) if kind.startswith(("array", "map", "struct")) else F.col(name).cast("string")


def rows_to_documents(
    rows: DataFrame,
    content_columns: Sequence[str],
    metadata_columns: Sequence[str] = (),
    id_column: str | None = None,
    time_column: str | None = None,
    source: str = "table:default",
) -> DataFrame:
    """Relational rows as documents ``(doc_id, semantic_id, content, metadata, updated_at)``.

    The content is one titled block per non-null column. The id is the source with the id column's value, or the
    digest of the content; the readable id is the first content column on one line, at most 100 characters.
    """
    block = lambda c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"【{c}】:\n"), _shown(rows, c)))
    content = F.concat_ws("\n\n", *[block(c) for c in content_columns])
    name = F.col(id_column).cast("string") if id_column else F.lit(None).cast("string")
    entries = [F.struct(F.lit(c).alias("key"), _shown(rows, c).alias("value")) for c in metadata_columns]
    metadata = (
        F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"].isNotNull()))
        if entries
        else F.create_map().cast("map<string,string>")
    )
    first = F.coalesce(_shown(rows, content_columns[0]), F.lit("database_record")) if content_columns else F.lit("database_record")
    return rows.select(
        F.concat(F.lit(source + ":"), F.coalesce(name, F.md5(content))).alias("doc_id"),
        F.substring(F.trim(F.translate(first, "\n\r", "  ")), 1, 100).alias("semantic_id"),
        content.alias("content"),
        metadata.alias("metadata"),
        (F.col(time_column) if time_column else F.current_timestamp()).alias("updated_at"),
    )


def incremental_rows(rows: DataFrame, time_column: str | None, low: Column | None = None, high: Column | None = None) -> DataFrame:
    """Rows of the half-open window ``low < time <= high``; unset bounds or no time column do not restrict."""
    if time_column is None:
        return rows
    if low is not None:
        rows = rows.filter(F.col(time_column) > low)
    if high is not None:
        rows = rows.filter(F.col(time_column) <= high)
    return rows


def max_cursor(tables: Sequence[DataFrame], time_column: str) -> DataFrame:
    """Largest time over several tables, taken before reading them, as a one-row table."""
    parts = [t.select(F.col(time_column).alias("cursor")).agg(F.max("cursor").alias("cursor")) for t in tables]
    return reduce(DataFrame.unionByName, parts).agg(F.max("cursor").alias("cursor"))


def slim_snapshot(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """Ids only, for finding deletions; other columns are never read."""
    return documents.select(key)


def map_json_items(
    payloads: DataFrame,
    items_path: str,
    content_fields: Sequence[str],
    metadata_fields: Sequence[str] = (),
    id_field: str | None = None,
    time_field: str | None = None,
    template: str | None = None,
    low: Column | None = None,
    high: Column | None = None,
    payload: str = "payload",
) -> DataFrame:
    """Items of JSON payloads as documents, by dotted paths.

    The content is the template with ``{path}`` places filled in, or the content fields line by line. Items outside
    the time window are left out, items without a time are kept.
    """
    listed = F.try_variant_get(F.try_parse_json(payload), "$." + items_path if items_path else "$", "array<string>")
    items = payloads.select(F.explode(listed).alias("item"))
    value = lambda path: sc.record_value(F.col("item"), path)
    if template is None:
        content = F.concat_ws("\n", *[value(p) for p in content_fields])
    else:
        content = F.lit(template)
        for path in content_fields:
            content = F.replace(content, F.lit("{" + path + "}"), F.coalesce(value(path), F.lit("")))
    when = sc.parse_datetime_any(value(time_field)) if time_field else F.lit(None).cast("timestamp")
    entries = [F.struct(F.lit(p).alias("key"), value(p).alias("value")) for p in metadata_fields]
    metadata = (
        F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"].isNotNull()))
        if entries
        else F.create_map().cast("map<string,string>")
    )
    documents = items.select(
        (F.coalesce(value(id_field), F.md5(content)) if id_field else F.md5(content)).alias("doc_id"),
        content.alias("content"),
        metadata.alias("metadata"),
        when.alias("updated_at"),
    )
    if low is not None:
        documents = documents.filter(F.col("updated_at").isNull() | (F.col("updated_at") > low))
    if high is not None:
        documents = documents.filter(F.col("updated_at").isNull() | (F.col("updated_at") <= high))
    return documents


FEED_SCHEMA = (
    "channel struct<item: array<struct<guid: string, link: string, title: string, description: string, "
    "pubDate: string, updated: string, author: string>>>"
)


def map_feed_entries(feeds: DataFrame, url: str = "url", xml: str = "xml") -> DataFrame:
    """Entries of feed documents: stable key, title, plain text and time.

    The key is the digest of the feed and the entry's id, else its link, else its title and time.
    """
    entries = feeds.select(
        F.col(url).alias("feed"), F.explode(F.from_xml(F.col(xml), FEED_SCHEMA)["channel"]["item"]).alias("e")
    ).select("feed", "e.*")
    stamp = F.coalesce(F.nullif("pubDate", F.lit("")), F.nullif("updated", F.lit("")))
    key = F.coalesce(F.nullif("guid", F.lit("")), F.nullif("link", F.lit("")), F.concat_ws("|", "title", stamp))
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.coalesce("description", F.lit("")), r"(?s)<[^>]*>", " "), r"\s+", " "))
    time = F.coalesce(
        F.try_to_timestamp(F.regexp_replace(stamp, "^[A-Za-z]{3}, ", ""), F.lit("dd MMM yyyy HH:mm:ss Z")),
        sc.parse_datetime_any(stamp),
    )
    return entries.select(
        F.md5(F.concat_ws("\u0001", "feed", key)).alias("doc_id"),
        "title",
        F.concat_ws("\n\n", F.nullif("title", F.lit("")), F.nullif(plain, F.lit(""))).alias("content"),
        "link",
        time.alias("updated_at"),
    )


def split_delimited(lines: DataFrame, header: Sequence[str], delimiter: str = "\t", line: str = "value") -> tuple[DataFrame, DataFrame]:
    """Rows of delimited lines as wide as the header, and the rejected lines."""
    pattern = "\\" + delimiter if delimiter in "|.^$*+?()[]{}\\" else delimiter
    parts = F.split(line, pattern, -1)
    fits = F.size(parts) == len(header)
    rows = lines.filter(fits).select(*[F.get(parts, F.lit(i)).alias(name) for i, name in enumerate(header)])
    return rows, lines.filter(~fits & F.col(line).rlike(r"\S")).select(line)


def read_delimited(spark: SparkSession, path: str, delimiter: str = "\t") -> tuple[DataFrame, DataFrame]:
    """Delimited text files that each begin with the header: rows of the header's width, and the rejected lines.

    A file's header is the line at its begin and no other, so data lines that look like it stay. Files whose header is
    another one than the first file's, by path, have all their lines rejected. One line comes to the driver.
    """
    # rows of a split keep their order, so the least number among those of the split at a file's begin is its first line
    place = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    lines = spark.read.text(path).select("value", *place, F.monotonically_increasing_id().alias("id"))
    heads = lines.filter("start = 0").groupBy("file").agg(F.min("id").alias("first"), F.min_by("value", "id").alias("head"))
    first = heads.orderBy("file").limit(1).first()
    header = first["head"] if first else ""
    placed = lines.join(heads, "file").withColumn("same", F.col("head") == header)
    rows, rejected = split_delimited(placed.filter("same AND id <> first").select("value"), header.split(delimiter), delimiter)
    other = placed.filter("NOT same").filter(F.col("value").rlike(r"\S")).select("value")
    return rows, rejected.unionByName(other)


def merge_tables(tables: Sequence[DataFrame], strategy: str = "concat", on: str | None = None) -> DataFrame:
    """Several tables below each other with aligned columns, or side by side by a full join on a key."""
    if strategy == "concat":
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return reduce(lambda a, b: a.join(b, on, "full"), tables)
