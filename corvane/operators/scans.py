"""Running totals, ordinals and ranks that never put one whole key, or the whole table, into one task.

A plain ordered window sorts all rows of a key in one task. Here rows are first cut into coarse ordered
buckets: each (key, bucket) is scanned on its own, bucket totals are added up per key, and the offset of
each bucket is joined back. The coarse column must agree with the order: sorting by (bucket, order) is the
order wanted.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.session import cut_lineage


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    bucket: Sequence[str],
    order: Sequence[Column | str],
    value: str,
    out: str,
    exclusive: bool = False,
) -> DataFrame:
    """Sum of ``value`` over all rows of the key up to this one (before this one when ``exclusive``)."""
    keys, bucket = list(keys), list(bucket)
    inside = Window.partitionBy(*keys, *bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy(*bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*keys, *bucket)
        .agg(F.sum(value).alias("_total"))
        .withColumn("_offset", F.coalesce(F.sum("_total").over(before), F.lit(0)))
        .drop("_total")
    )
    total = F.col("_offset") + F.col("_inside") - (F.col(value) if exclusive else F.lit(0))
    renamed = {k: f"_at{i}" for i, k in enumerate([*keys, *bucket])}
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(v)) for k, v in renamed.items()])
    return (
        df.withColumn("_inside", F.sum(value).over(inside))
        .join(offsets.withColumnsRenamed(renamed), same)
        .withColumn(out, total)
        .drop("_inside", "_offset", *renamed.values())
    )


def ordinal(
    df: DataFrame, keys: Sequence[str], bucket: Sequence[str], order: Sequence[Column | str], out: str
) -> DataFrame:
    """1-based position of each row within its key."""
    return running_total(df.withColumn("_one", F.lit(1).cast("bigint")), keys, bucket, order, "_one", out).drop("_one")


def range_total(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], value: str, out: str, ranges: int | None = None) -> DataFrame:
    """Sum of ``value`` over the rows of the key up to this one, for any order and any spread of its values.

    Rows are cut at splitters that Spark samples from (keys, order), and equal rows by their place in the input, so
    ranges are about equal whatever the values are. Ranges are scanned on their own and their totals added up on two
    levels. Rows that are equal in all of the order stand in the order of the input.
    """
    keys, columns = list(keys), [F.col(c) if isinstance(c, str) else c for c in order]
    spark = df.sparkSession
    ranges = ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    marked = cut_lineage(df.withColumn("_tie", F.monotonically_increasing_id()))
    by = [*[F.col(k) for k in keys], *columns, F.col("_tie")]
    cut = cut_lineage(marked.repartitionByRange(ranges, *by).withColumn("_range", F.spark_partition_id()))
    inside = Window.partitionBy(*keys, "_range").orderBy(*columns, "_tie").rowsBetween(Window.unboundedPreceding, 0)
    sums = cut.groupBy(*keys, "_range").agg(F.sum(value).alias("_sum")).withColumn("_lot", F.floor(F.col("_range") / 1024))
    before = running_total(sums.withColumn("_none", F.lit(0)), ["_none", *keys], ["_lot"], ["_range"], "_sum", "_before", exclusive=True)
    before = before.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_range").alias("_of"), "_before")
    same = F.col("_range") == F.col("_of")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    placed = cut.withColumn("_inside", F.sum(value).over(inside)).join(before, same)
    return placed.withColumn(out, F.col("_before") + F.col("_inside")).select(*df.columns, out)


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], out: str = "rank", ranges: int | None = None) -> DataFrame:
    """Rank of each row within its key, or within the table without keys, by :func:`range_total`."""
    return range_total(df.withColumn("_one", F.lit(1).cast("bigint")), keys, order, "_one", out, ranges).drop("_one")
