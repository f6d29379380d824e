"""Incremental sync: what to fetch, what changed, what is gone, what can be reused."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def listing_diff(listing: DataFrame, stored: DataFrame, key: str = "key") -> DataFrame:
    """Listed objects with ``action`` fetch or skip.

    An object is skipped when its fingerprint equals the stored one; an empty or unknown fingerprint means fetch.
    Deletion records are left to the snapshot comparison.
    """
    known = stored.select(key, F.col("fingerprint").alias("_known"))
    same = F.coalesce((F.col("fingerprint") != "") & (F.col("fingerprint") == F.col("_known")), F.lit(False))
    return (
        listing.filter(~F.coalesce("deleted", F.lit(False)))
        .join(known, key, "left")
        .withColumn("action", F.when(same, "skip").otherwise("fetch"))
        .drop("_known")
    )


def stale_documents(existing: DataFrame, snapshot: DataFrame, key: str = "doc_id") -> DataFrame:
    """Existing documents the current snapshot no longer lists."""
    return existing.join(snapshot.select(key).distinct(), key, "left_anti")


def sync_classify(batch: DataFrame, existing: DataFrame, key: str = "doc_id", time: str = "updated_at") -> tuple[DataFrame, DataFrame]:
    """Batch rows marked added or updated, and the next lower bound: the latest time seen, never moving back."""
    known = existing.select(key, F.lit(True).alias("_known")).distinct()
    marked = batch.join(known, key, "left").withColumn("change", F.when(F.col("_known"), "updated").otherwise("added")).drop("_known")
    return marked, batch.agg(F.max(time).alias("next_update"))


def advance(cursor: Column, seen: Column) -> Column:
    """The later of the stored bound and a batch's latest time; an empty batch changes nothing."""
    return F.greatest(cursor, F.coalesce(seen, cursor))


def digest(columns: Sequence[Column]) -> Column:
    """Digest of a unit of work's settings."""
    return F.sha2(F.concat_ws("\u0001", *[F.coalesce(c.cast("string"), F.lit("\u0002")) for c in columns]), 256)


def reuse_by_digest(tasks: DataFrame, previous: DataFrame, keys: Sequence[str] = ("digest", "start")) -> DataFrame:
    """Tasks with the chunk ids of an equal, finished earlier unit; null means the work has to be done.

    ``previous(digest, start, progress, chunk_ids)`` counts when complete and with chunks.
    """
    finished = previous.filter((F.col("progress") >= 1) & (F.coalesce("chunk_ids", F.lit("")) != ""))
    done = finished.groupBy(*keys).agg(F.max("chunk_ids").alias("reused"))
    return tasks.join(done, list(keys), "left")
