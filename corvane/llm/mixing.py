"""Mixing sources to target weights: repetition rates by source, whole copies and one drawn copy per document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.session import cut_lineage

SPACES = "[\\x20\\x09-\\x0D]+"


def words_of(text: str | Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def draw(key: str | Column, seed: int) -> Column:
    """A number in [0, 1) fixed by key and seed: the first 52 bits of an md5 digest. A null key counts as empty."""
    name = (F.col(key) if isinstance(key, str) else key).cast("string")
    digest = F.md5(F.concat(F.coalesce(name, F.lit("")), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def source_targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: int = 150, cap: int = 2) -> DataFrame:
    """Targets ``(source, source_size, target)`` from ``(source, size)`` rows.

    The sources in code-point order, null last, get the weights in turn. Together they share ``share`` percent of all
    sizes; a target stops at ``cap`` times its source's size, and what it cannot take goes to the others by weight.
    A source is full when the level (what is left for each unit of weight) reaches its size per weight, so the full
    ones are found in rounds, each of which is one sum over the sources; a round that fills none is the last.
    Sources without any word have target 0. Empty input gives no rows.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(ranked) - 1, F.lit(len(weights)))
    given = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (place + 1).cast("int"))
    sources = cut_lineage(sources.select("source", "source_size", given.alias("weight")))  # one row per source
    room = F.col("source_size") * cap
    level = None
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    while True:
        full = F.lit(False) if level is None else (room <= F.col("weight") * F.lit(level))
        filled, open_weight, n_full = sources.agg(
            F.sum(F.when(full, room).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight"))), F.sum(full.cast("int"))
        ).first()
        if level is not None and n_full == known:
            break
        known = n_full
        if not open_weight:
            break
        level = (total * share / 100 - filled) / open_weight
    target = F.lit(0.0) if level is None else F.least(room.cast("double"), F.col("weight") * F.lit(float(level)))
    return sources.select("source", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    size: Column,
    key: str = "doc_id",
    source: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    share: int = 150,
    cap: int = 2,
    seed: int = 4,
) -> DataFrame:
    """All rows of ``docs`` with ``mix_size, mix_source_size, mix_target, mix_copies``.

    A source's rate is its target divided by its size. Each document gets floor(rate) copies, and one more if a draw
    fixed by its key and the seed is below the fraction; so reruns agree and no document is emitted more than
    ceil(rate) times. Rows with equal keys get the same draw. Null texts have size 0; null sources form one source.
    Only (source, size) pairs, summed before the shuffle, are gathered; the texts stay where they are while the small
    table of rates comes to them.
    """
    sized = docs.withColumn("mix_size", size.cast("bigint"))
    rates = source_targets(sized.select(F.col(source).alias("source"), F.col("mix_size").alias("size")), weights, share, cap)
    rates = cut_lineage(rates.select(F.col("source").alias("_mix_source"), F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target")))
    rate = F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")).otherwise(0.0)
    whole = F.floor(rate)
    copies = whole + (draw(key, seed) < rate - whole).cast("bigint")
    return sized.join(rates, sized[source].eqNullSafe(rates["_mix_source"]), "inner").drop("_mix_source").withColumn("mix_copies", copies)


def emit_copies(mixed: DataFrame) -> DataFrame:
    """The mix itself: every document as often as ``mix_copies`` says, without the helper columns."""
    columns = [c for c in mixed.columns if not c.startswith("mix_")]
    copies = F.explode(F.array_repeat(F.lit(0), F.col("mix_copies").cast("int")))
    return mixed.select(*[F.col(f"`{c}`") for c in columns], copies.alias("_copy")).drop("_copy")
