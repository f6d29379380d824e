"""Facets, summaries and merges. Every aggregate combines on the map side; list columns come in bounded blocks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions import scalars as sc
from corvane.functions import text as tx
from corvane.operators.scans import range_total, ranked
from corvane.session import cut_lineage


def terms_count(df: DataFrame, field: str) -> DataFrame:
    """Facet counts ``(value, n)`` of a scalar or array field; values are trimmed, empty ones skipped."""
    is_array = dict(df.dtypes)[field].startswith("array")
    value = F.explode(F.col(field)) if is_array else F.col(field)
    return (
        df.select(value.alias("value"))
        .select(F.trim(F.col("value").cast("string")).alias("value"))
        .filter(F.col("value") != "")
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def doc_aggs(hits: DataFrame) -> DataFrame:
    """Hits per query and document name with the first document id by rank."""
    return hits.groupBy("query_id", "doc_name").agg(
        F.count(F.lit(1)).alias("n"), F.min_by("doc_id", "rank").alias("doc_id")
    )


def tag_portions(tags: DataFrame, smoothing: int = 1000) -> DataFrame:
    """Share of each tag in the corpus, ``(n + 1) / (total + smoothing)``; ``tags`` has one row per tagging."""
    counts = terms_count(tags, "tag")
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(F.col("value").alias("tag"), "n", ((F.col("n") + 1) / (total + smoothing)).alias("portion"))


def merge_tag_counts(counts: Sequence[DataFrame]) -> DataFrame:
    """Sum of tag counts over several datasets."""
    return reduce(DataFrame.unionByName, counts).groupBy("tag").agg(F.sum("n").alias("n"))


def value_type(value: Column, listed: Column) -> Column:
    """Type class of a metadata value: list, number, time or string."""
    return (
        F.when(listed, "list")
        .when(value.rlike(r"^-?\d+(\.\d+)?$"), "number")
        .when(value.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$"), "time")
        .otherwise("string")
    )


def metadata_summary(meta: DataFrame) -> DataFrame:
    """Per key and value the number of documents, with the key's majority type (ties by name)."""
    per_doc = meta.groupBy("doc_id", "key").agg(
        F.max("value").alias("value"), (F.count(F.lit(1)) > 1).alias("listed")
    )
    types = (
        per_doc.groupBy("key", value_type(F.col("value"), F.col("listed")).alias("type"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("key")
        .agg(F.min_by("type", F.struct(-F.col("n"), F.col("type"))).alias("type"))
    )
    values = meta.groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))
    return values.join(types, "key")


def flatten_metadata(meta: DataFrame) -> DataFrame:
    """Inverted metadata ``(key, value, doc_ids, n)``: one row per key and value, whatever its number of documents.

    The distinct pairs are the long form of the same table, for values whose list should not stand in one row.
    """
    return (
        meta.select("key", "value", "doc_id")
        .distinct()
        .groupBy("key", "value")
        .agg(F.array_sort(F.collect_list("doc_id")).alias("doc_ids"), F.count(F.lit(1)).alias("n"))
    )


def doc_facets(documents: DataFrame, meta: DataFrame) -> DataFrame:
    """Document counts per suffix, per status and per metadata value, and the documents without metadata."""
    by = lambda kind, column: documents.groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    ).select(F.lit(kind).alias("facet"), F.col("value").cast("string").alias("value"), "n")
    values = (
        meta.join(documents.select("doc_id"), "doc_id", "left_semi")
        .groupBy("key", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.concat(F.lit("metadata."), F.col("key")).alias("facet"), "value", "n")
    )
    empty = (
        documents.join(meta.select("doc_id").distinct(), "doc_id", "left_anti")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit("empty_metadata").alias("facet"), F.lit("true").alias("value"), "n")
    )
    return by("suffix", "suffix").unionByName(by("run", "run")).unionByName(values).unionByName(empty)


def parsing_status(documents: DataFrame, statuses: Sequence[str]) -> DataFrame:
    """Documents per dataset and status, zero where there are none."""
    return documents.groupBy("dataset_id").pivot("run", list(statuses)).agg(F.count(F.lit(1))).na.fill(0)


def usage_stats(conversations: DataFrame) -> DataFrame:
    """Per day: conversations, distinct users, token speed, thousands of tokens, mean rounds, thumbs up.

    Input columns: ``created_at, user_id, tokens, duration, rounds, thumb_up``.
    """
    per_day = conversations.groupBy(F.to_date("created_at").alias("day")).agg(
        F.count(F.lit(1)).alias("pv"),
        F.countDistinct("user_id").alias("uv"),
        F.sum("tokens").alias("_tokens"),
        F.sum("duration").alias("_duration"),
        F.avg("rounds").alias("rounds"),
        F.sum("thumb_up").alias("thumb_up"),
    )
    return per_day.select(
        "day",
        "pv",
        "uv",
        (F.col("_tokens") / (F.col("_duration") + 0.1)).alias("speed"),
        (F.col("_tokens") / 1000.0).alias("tokens"),
        "rounds",
        "thumb_up",
    )


def approx_usage(conversations: DataFrame, error: float = 0.02) -> DataFrame:
    """Distinct users per day by sketch, for data where exact distinct counting costs too much."""
    return conversations.groupBy(F.to_date("created_at").alias("day")).agg(
        F.count(F.lit(1)).alias("pv"), F.approx_count_distinct("user_id", error).alias("uv")
    )


def usage_sketches(conversations: DataFrame, log_size: int = 12) -> DataFrame:
    """Per day: conversations, a sketch of the distinct users and one of the durations, to be stored and merged.

    ``users`` is a HyperLogLog sketch of 2^``log_size`` registers, ``durations`` a quantile sketch; both have a size
    that does not grow with the rows. The same aggregation serves batches and streams.
    """
    return conversations.groupBy(F.to_date("created_at").alias("day")).agg(*usage_sketch_columns(log_size))


def usage_sketch_columns(log_size: int = 12) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("pv"),
        F.hll_sketch_agg("user_id", log_size).alias("users"),
        F.kll_sketch_agg_double(F.col("duration").cast("double")).alias("durations"),
    ]


def merge_usage(sketches: DataFrame, span: Column, percentiles: Sequence[int] = (50, 90)) -> DataFrame:
    """Usage over longer spans out of stored days: ``span``, conversations, estimated users, duration percentiles.

    Users seen on several days of a span count once, which sums of daily numbers cannot do. Relative error of ``users``:
    1.04 / sqrt(registers); error of a percentile's rank: about one and a half in a hundred.
    """
    parts = F.transform(F.array_sort(F.collect_list(F.struct("day", "durations"))), lambda e: e["durations"])
    merged = sketches.groupBy(span.alias("span")).agg(F.sum("pv").alias("pv"), F.hll_union_agg("users").alias("users"), parts.alias("parts"))
    whole = F.aggregate(F.slice("parts", F.lit(2), F.size("parts")), F.get("parts", F.lit(0)), lambda a, b: F.kll_sketch_merge_double(a, b))
    return merged.withColumn("_whole", whole).select(
        "span", "pv", F.hll_sketch_estimate("users").alias("users"),
        *[F.kll_sketch_get_quantile_double("_whole", F.lit(p / 100)).alias(f"p{p}") for p in percentiles],
    )


def item_rows(df: DataFrame, keys: Sequence[str], item: str, order: Sequence[Column | str] | None = None) -> DataFrame:
    """The long form of a list column: ``keys, position, item`` with positions from 0, for keys of any number of items.

    Without ``order`` the items are distinct and in their own order, as in the lists; with one, all rows count.
    """
    named = [F.col(k) for k in keys]
    rows = df.filter(F.col(item).isNotNull())
    rows = rows.select(*named, item).distinct() if order is None else rows
    placed = ranked(rows, keys, [item] if order is None else order, "_place")
    return placed.select(*named, (F.col("_place") - 1).alias("position"), F.col(item).alias("item"))


def dataset_totals(documents: DataFrame) -> DataFrame:
    """Documents, chunks, tokens and bytes per dataset."""
    return documents.groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum("chunk_num").alias("chunks"),
        F.sum("token_num").alias("tokens"),
        F.sum("size").alias("size"),
    )


def folder_sizes(folders: DataFrame, files: DataFrame) -> DataFrame:
    """Total size of each folder with all below it; ``folders(folder_id, parent_id)``, ``files(folder_id, size)``.

    Pointer doubling: after k rounds a folder's sum holds all that lies less than 2^k levels below it, and its pointer
    leads 2^k levels up; every round adds each sum to the folder pointed at and doubles the pointers, so rounds grow
    with the logarithm of the depth. A root is its own parent, has none, or names one that is no folder. Files of
    unknown folders are left out; folders that lie in each other raise ``ValueError``.
    """
    direct = files.groupBy(F.col("folder_id").alias("_in")).agg(F.sum("size").alias("size"))
    up = F.when(F.col("parent_id") != F.col("folder_id"), F.col("parent_id"))
    own = folders.select("folder_id", up.alias("up")).join(direct, F.col("folder_id") == F.col("_in"), "left")
    state = cut_lineage(own.select("folder_id", "up", F.coalesce("size", F.lit(0)).alias("size")))
    rounds = max(1, state.count()).bit_length() + 1
    for _ in range(rounds):
        open_ = state.filter("up IS NOT NULL")
        if open_.isEmpty():
            return state.select("folder_id", "size")
        gains = open_.groupBy(F.col("up").alias("_to")).agg(F.sum("size").alias("_gain"))
        above = state.select(F.col("folder_id").alias("_of"), F.col("up").alias("_up"))
        moved = state.join(above, F.col("up") == F.col("_of"), "left").join(gains, F.col("folder_id") == F.col("_to"), "left")
        state = cut_lineage(moved.select("folder_id", F.col("_up").alias("up"), (F.col("size") + F.coalesce("_gain", F.lit(0))).alias("size")))
    if state.filter("up IS NOT NULL").isEmpty():
        return state.select("folder_id", "size")
    raise ValueError("some folders lie in each other")


def message_size(content: Column, vector: Column | None = None) -> Column:
    """Bytes of a stored message: its text in UTF-8 plus eight per vector element."""
    size = F.octet_length(content).cast("bigint")
    return size if vector is None else size + F.coalesce(F.size(vector), F.lit(0)) * 8


def memory_size(messages: DataFrame) -> DataFrame:
    """Stored bytes per memory."""
    return messages.groupBy("memory_id").agg(F.sum(message_size(F.col("content"))).alias("size"))


def combine_records(records: DataFrame, group: str, order: str) -> DataFrame:
    """Values of equal keys over many ``map<string,array<string>>`` records, in record order.

    One row per (group, key): the values (lists flattened), and whether the key was a single scalar.
    """
    values = records.select(group, order, F.explode("record").alias("key", "value"))
    return (
        values.groupBy(group, "key")
        .agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(order, "value"))), lambda e: e["value"])).alias("values"))
        .withColumn("scalar", F.size("values") == 1)
    )


def joined_text(df: DataFrame, keys: Sequence[str], column: str, separator: str, out: str | None = None) -> DataFrame:
    """Sorted distinct values of a text column per key, joined: one row per key that has any.

    Repeats go before the lists are built, and on the map side first.
    """
    distinct = df.filter(F.col(column).isNotNull() & (F.col(column) != "")).select(*keys, column).distinct()
    return distinct.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(column)), separator).alias(out or column))


def merge_entity_mentions(mentions: DataFrame, separator: str = "<SEP>") -> DataFrame:
    """One row per entity: majority type (ties by name), distinct descriptions joined in order, number and ids of sources.

    Input ``name, type, description, source_id``; ``source_ids`` is a sorted array.
    """
    types = (
        mentions.groupBy("name", "type")
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("name")
        .agg(F.min_by("type", F.struct(-F.col("_n"), F.col("type"))).alias("type"), F.sum("_n").alias("mentions"))
    )
    texts = joined_text(mentions, ["name"], "description", separator)
    return types.join(source_lists(mentions, ["name"]), "name").join(texts, "name", "left")


def source_lists(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number and sorted ids of the distinct sources of each key."""
    distinct = df.select(*keys, "source_id").distinct()
    return distinct.groupBy(*keys).agg(F.count("source_id").alias("sources"), F.array_sort(F.collect_list("source_id")).alias("source_ids"))


def unordered(df: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Edge ends in sorted order."""
    return df.withColumns({src: F.least(src, dst), dst: F.greatest(src, dst)})


def merge_relation_mentions(mentions: DataFrame, separator: str = "<SEP>") -> DataFrame:
    """One row per unordered pair: summed weight, distinct descriptions and keywords joined, number and ids of sources."""
    pairs = unordered(mentions)
    ends = ["src", "dst"]
    out = pairs.groupBy(*ends).agg(F.sum("weight").alias("weight")).join(source_lists(pairs, ends), ends)
    out = out.join(joined_text(pairs, ends, "description", separator), ends, "left")
    return out.join(joined_text(pairs, ends, "keywords", ","), ends, "left")


def table_metadata(rows: DataFrame, columns: Sequence[str], order: str) -> DataFrame:
    """Distinct non-empty values per metadata column ``(column, value, position)``, ordered by first row."""
    long = rows.select(
        F.col(order).alias("_order"),
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.trim(F.col(c).cast("string")).alias("value")) for c in columns])
        ).alias("e"),
    ).select("_order", "e.*")
    firsts = long.filter(F.col("value") != "").groupBy("column", "value").agg(F.min("_order").alias("first_row"))
    return firsts


def merge_doc_metadata(chunk_meta: DataFrame) -> DataFrame:
    """Chunk metadata folded to the document: ``(doc_id, ord, key, value, listed)`` rows.

    Lists become the distinct values in first-seen order, scalars keep the last chunk's value. One row per
    (document, key, value) with its position; scalars have exactly one.
    """
    lists = (
        chunk_meta.filter("listed")
        .groupBy("doc_id", "key", "value")
        .agg(F.min("ord").alias("ord"))
    )
    scalars = (
        chunk_meta.filter("NOT listed")
        .groupBy("doc_id", "key")
        .agg(F.max_by("value", "ord").alias("value"), F.max("ord").alias("ord"))
        .select("doc_id", "key", "value", "ord")
    )
    return lists.unionByName(scalars)


def message_stats(messages: DataFrame) -> DataFrame:
    """Highest turn, number of messages and latest time per memory."""
    return messages.groupBy("memory_id").agg(
        F.max("turn").alias("max_turn"), F.count(F.lit(1)).alias("n"), F.max("valid_at").alias("latest")
    )


def embedding_drift(stored: DataFrame, fresh: DataFrame, accept: float = 0.9) -> DataFrame:
    """Compare stored vectors with newly computed ones: mean, least and greatest cosine and the verdict.

    ``stored(chunk_id, embedding)``; ``fresh(chunk_id, content_vec, title_vec)``. Each row takes the better of the
    content vector alone and the blend with the title.
    """
    plain = sc.cosine(F.col("embedding"), F.col("content_vec"))
    mixed = sc.cosine(F.col("embedding"), sc.blend_vectors(F.col("title_vec"), F.col("content_vec")))
    rows = stored.join(fresh, "chunk_id").select(F.greatest(plain, mixed).alias("similarity"))
    return rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("similarity").alias("avg_similarity"),
        F.min("similarity").alias("min_similarity"),
        F.max("similarity").alias("max_similarity"),
    ).withColumn("compatible", F.col("avg_similarity") >= accept)


def evaluation_summary(results: DataFrame) -> DataFrame:
    """Mean of each metric over the cases of a run, mean time, and the advice each value triggers.

    ``results(run_id, case_id, metric, value)``; the metric ``execution_time`` is the time of the case.
    """
    means = results.groupBy("run_id", "metric").agg(
        F.avg("value").alias("average"), F.count(F.lit(1)).alias("cases")
    )
    average = F.round("average", 9)  # a mean at the limit must not hang on the order of additions
    advice = (
        F.when((F.col("metric") == "precision") & (average < 0.7), "Low Precision")
        .when((F.col("metric") == "recall") & (average < 0.7), "Low Recall")
        .when((F.col("metric") == "execution_time") & (average > 5.0), "Slow Response Time")
    )
    return means.withColumn("issue", advice)


def latency_summary(samples: DataFrame, percentiles: Sequence[int] = (50, 90, 95)) -> DataFrame:
    """Per group: count, mean, least, greatest and nearest-rank percentiles of ``value``.

    Values are counted first, then their running count over sampled ranges finds the rank, so a group holding most of
    the rows, or all of its values close together, is not sorted in one task.
    """
    counts = samples.groupBy("group", "value").agg(F.count(F.lit(1)).alias("n"))
    upto = range_total(counts, ["group"], ["value"], "n", "upto")
    totals = samples.groupBy("group").agg(
        F.count(F.lit(1)).alias("count"),
        F.avg("value").alias("avg"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    rank = lambda p: F.greatest(F.ceil(F.col("count") * p / 100.0), F.lit(1))
    picks = [F.min(F.when(F.col("upto") >= rank(p), F.col("value"))).alias(f"p{p}") for p in percentiles]
    at_rank = upto.join(totals.select("group", "count"), "group").groupBy("group").agg(*picks)
    return totals.join(at_rank, "group")


def type_samples(entities: DataFrame, n: int) -> DataFrame:
    """The first ``n`` entity names of each type."""
    ranked = entities.select("type", "name").distinct().withColumn(
        "_rank", F.row_number().over(Window.partitionBy("type").orderBy("name"))
    )
    return (
        ranked.filter(F.col("_rank") <= n)
        .groupBy("type")
        .agg(F.array_sort(F.collect_list("name")).alias("names"))
    )
