"""Streams into tables: ingestion, bad records, replays, pruning, statistics, graph increments, resumed phases."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.sources import store, sync


def read_files(spark: SparkSession, folder: str, schema: T.StructType, name: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """File stream of a folder, or of the table ``name`` in it; each file is read once, as the checkpoint remembers.

    A table is one file or a folder of files. A pattern that only its name fits finds both, where a filter of file
    names would find nothing in a folder.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder if name is None else f"{folder}/[{name[0]}]{name[1:]}")


def run_available(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process all that is there in micro-batches, then stop.

    A batch that fails is not recorded in the checkpoint and comes again at the next start, so the position only
    moves past finished batches.
    """
    query = (
        stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def stream_ingest(stream: DataFrame, to_documents: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> None:
    """Source rows to documents, each micro-batch into its own folder of the target.

    The folder name is the batch number, so a repeated batch replaces itself.
    """
    run_available(
        stream, lambda rows, n: to_documents(rows).write.mode("overwrite").parquet(f"{target}/batch={n}"), checkpoint
    )


def checkpointed_load(
    stream: DataFrame, parse: Callable[[DataFrame], DataFrame], failed: str, target: str, errors: str, checkpoint: str
) -> None:
    """Load that reports rows it cannot read instead of stopping.

    ``parse`` adds the boolean column ``failed``; such rows go to the error table with their batch number.
    """

    def split(rows: DataFrame, n: int) -> None:
        parsed = parse(rows).persist()
        parsed.filter(~F.col(failed)).drop(failed).write.mode("overwrite").parquet(f"{target}/batch={n}")
        parsed.filter(F.col(failed)).drop(failed).write.mode("overwrite").parquet(f"{errors}/batch={n}")
        parsed.unpersist()

    run_available(stream, split, checkpoint)


def idempotent_upsert(stream: DataFrame, target: str, checkpoint: str, key: str = "chunk_id", order: str = "at") -> None:
    """Stream into the chunk store: of all versions of an id, the one of largest ``order`` stays.

    The stored row is kept where it is newer, so repeats, replays and late versions change nothing, and late rows of
    new ids are stored; no state is held between batches.
    """
    run_available(stream, lambda rows, n: store.write_chunks(rows, target, key, order), checkpoint)


def usage_stats_stream(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Usage per UTC day of event time; rows later than the delay are not counted (the batch form counts them).

    Distinct users are sketched, since exact sets would grow the state without bound.
    """
    return (
        events.withWatermark("created_at", delay)
        .groupBy(F.window("created_at", "1 day").alias("w"))
        .agg(
            F.count(F.lit(1)).alias("pv"),
            F.approx_count_distinct("user_id", 0.02).alias("uv"),
            (F.sum("tokens") / (F.sum("duration") + 0.1)).alias("speed"),
            (F.sum("tokens") / 1000.0).alias("tokens"),
            F.avg("rounds").alias("rounds"),
            F.sum("thumb_up").alias("thumb_up"),
        )
        .select(F.to_date(F.to_utc_timestamp("w.start", F.current_timezone())).alias("day"), "pv", "uv", "speed", "tokens", "rounds", "thumb_up")
    )


def usage_sketch_stream(events: DataFrame, target: str, checkpoint: str) -> None:
    """Days with their sketches of users and durations, in a state that does not grow with the rows.

    Every batch replaces the whole table of days, so a replay changes nothing; ``merge_usage`` reads it.
    """
    from corvane.operators.aggregates import usage_sketches

    grown = usage_sketches(events).writeStream.outputMode("complete")
    write = lambda rows, n: rows.write.mode("overwrite").parquet(target)
    grown.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def prune_stream(snapshots: DataFrame, existing: Callable[[], DataFrame], removed: str, checkpoint: str, key: str = "doc_id") -> None:
    """For each arriving snapshot, the stored documents it no longer lists."""
    run_available(
        snapshots,
        lambda rows, n: sync.stale_documents(existing(), rows, key).write.mode("overwrite").parquet(f"{removed}/batch={n}"),
        checkpoint,
    )


def graph_increment(mentions: DataFrame, merge: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> None:
    """Relation mentions of new documents into the stored graph; the graph's own sums make it equal a rebuild.

    Each micro-batch is aggregated first and written as its own part; readers add the parts up.
    """
    run_available(mentions, lambda rows, n: merge(rows).write.mode("overwrite").parquet(f"{target}/batch={n}"), checkpoint)


def phase_resume(units: DataFrame, finished: DataFrame, keys: Sequence[str] = ("digest", "phase")) -> DataFrame:
    """Units of work whose phase has not been finished under the same digest."""
    return units.join(finished.select(*keys).distinct(), list(keys), "left_anti")
