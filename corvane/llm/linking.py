"""From band buckets to groups: candidate pairs without all pairs of a bucket, exact checks on sets, union-find by joins."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm import blocks
from corvane.session import cut_lineage, discard, scratch

PARTNERS = 1000  # pairs of one hub that are checked together; more are dealt over several salts
BLOCK_ITEMS = 512  # items of a block that meet another block in one task
CLOSE = 4  # a cloud of up to so many blocks is compared in full
PAIRED = 32  # in larger clouds, buckets of up to so many items give their pairs


def bucket_members(items: DataFrame) -> DataFrame:
    """``(band, item, size, low)`` of the buckets that hold two different items or more; ``low`` is the smallest one.

    ``items`` has ``item, size, bands``. Copies of an item count once. The smallest and largest item of a bucket are
    found with map-side sums and written, so that the join meets two plain sides and can split a large bucket.
    """
    rows = items.select(F.explode("bands").alias("band"), "item", "size")
    shared = rows.groupBy("band").agg(F.min("item").alias("low"), F.max("item").alias("high")).filter("low < high")
    return cut_lineage(rows.join(cut_lineage(shared.select("band", "low")), "band").repartition("item", "band").distinct())


def sorted_members(items: DataFrame, bands: int | None = None, at_once: int = 5) -> DataFrame:
    """What :func:`bucket_members` gives, from one exchange: rows are sorted by 48 bits of the band and by item.

    A stream over a task's rows hands on those of buckets with two different items and holds one row, however large a
    bucket is. Bands that agree in 48 bits by chance are one bucket, whose pairs are checked like any others.

    Where ``bands`` says how many bands an item has at most, ``at_once`` of them cross an exchange together, as buckets
    of different bands share nothing. Each lot is written before the next one is dealt, so the disk holds one lot.
    """

    def shared(batches):
        kept = [np.zeros(0, np.int64)] * 3  # the only row so far of the bucket at the end of the batch before
        open_band, low, last = None, 0, 0  # a bucket that went on from there and has been handed on
        for batch in batches:
            band, item, size = (np.concatenate([k, batch.column(c).to_numpy()]) for c, k in enumerate(kept))
            kept = [np.zeros(0, np.int64)] * 3
            if not len(band):
                continue
            new = np.ones(len(band), dtype=bool)
            new[1:] = (band[1:] != band[:-1]) | (item[1:] != item[:-1])
            if open_band is not None and band[0] == open_band and item[0] == last:
                new[0] = False
            band, item, size = band[new], item[new], size[new]
            if not len(band):
                continue
            starts = np.flatnonzero(np.concatenate([[True], band[1:] != band[:-1]]))
            counts = np.diff(np.append(starts, len(band)))
            lows = item[starts]
            goes_on = open_band is not None and band[0] == open_band
            if goes_on:
                lows[0] = low
            full = counts > 1
            full[0] |= goes_on
            if not full[-1]:
                kept, open_band = [band[-1:], item[-1:], size[-1:]], None
            else:
                open_band, low, last = band[-1], lows[-1], item[-1]
            rows = np.repeat(full, counts)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (band[rows], item[rows], size[rows], np.repeat(lows, counts)[rows])], names=["band", "item", "size", "low"])

    def members(lot) -> DataFrame:
        rows = items.select(F.explode(lot).alias("band"), "item", F.col("size").cast("bigint").alias("size"))
        rows = rows.withColumn("band", F.shiftright("band", 16))
        dealt = rows.repartition("band").sortWithinPartitions("band", "item")
        return cut_lineage(dealt.mapInArrow(shared, "band bigint, item bigint, size bigint, low bigint"))

    lots = ["bands"] if bands is None else [F.slice("bands", first + 1, at_once) for first in range(0, bands, at_once)]
    return reduce(DataFrame.unionByName, [members(lot) for lot in lots])


def hub_pairs(members: DataFrame, percent: int) -> DataFrame:
    """One pair ``(a, b)`` for each item: with the bucket minimum that it meets most often."""
    met = members.join(members.filter("item = low").select("band", F.col("size").alias("hub_size")), "band")
    met = met.filter("item > low").filter(_sizes_fit("size", "hub_size", percent))
    counted = met.groupBy("item", "low").agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy("item").agg(F.max_by("low", F.struct("n", "low")).alias("a"))
    return best.select("a", F.col("item").alias("b"))


def _sizes_fit(x: str, y: str, percent: int):
    """Sets whose sizes differ too much cannot share ``percent`` of their union."""
    return F.least(F.col(x), F.col(y)) * 100 >= F.greatest(F.col(x), F.col(y)) * percent


def mixed_buckets(members: DataFrame, groups: DataFrame) -> DataFrame:
    """``(band, item, size, group, items)`` of the buckets that hold items of two groups or more, and how many ``items``."""
    labelled = members.select("band", "item", "size").join(groups, "item", "left").withColumn("group", F.coalesce("group", "item"))
    parts = labelled.groupBy("band", "group").agg(F.count(F.lit(1)).alias("n"))
    mixed = parts.groupBy("band").agg(F.sum("n").alias("items"), F.count(F.lit(1)).alias("parts")).filter("parts > 1")
    return cut_lineage(labelled.join(cut_lineage(mixed.select("band", "items")), "band"))


def bucket_clouds(mixed: DataFrame) -> DataFrame:
    """``(item, cloud, blocks)``: items that a chain of buckets connects are a cloud of some blocks of ``BLOCK_ITEMS``."""
    lows = cut_lineage(mixed.groupBy("band").agg(F.min("item").alias("low")))
    edges = mixed.join(lows, "band").filter("item <> low").select(F.col("low").alias("a"), F.col("item").alias("b")).distinct()
    clouds = union_find(edges).withColumnRenamed("group", "cloud")
    sizes = cut_lineage(clouds.groupBy("cloud").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ITEMS).cast("int").alias("blocks")))
    return cut_lineage(clouds.join(sizes, "cloud").select("item", "cloud", "blocks"))


def open_pairs(mixed: DataFrame, percent: int) -> DataFrame:
    """The different pairs ``(a, b)``, ``a < b``, of two groups that share a bucket; as many as buckets hold, squared."""
    left = mixed.select("band", F.col("item").alias("a"), F.col("size").alias("x"), F.col("group").alias("g"))
    right = mixed.select("band", F.col("item").alias("b"), F.col("size").alias("y"), F.col("group").alias("h"))
    return left.join(right, "band").filter("a < b and g <> h").filter(_sizes_fit("x", "y", percent)).select("a", "b").distinct()


def _meet(values: np.ndarray, bounds: np.ndarray, cut: int = 0) -> np.ndarray:
    """Sizes of the intersections of the sets of a block, as a matrix: of all of them, or of the first ``cut`` with the rest."""
    n = len(bounds) - 1
    owner = np.repeat(np.arange(n), np.diff(bounds))
    _, column, counts = np.unique(values, return_inverse=True, return_counts=True)
    met = np.zeros((cut or n, n - cut), dtype=np.float32)
    often = counts >= 8
    name = np.cumsum(often) - 1
    for first in range(0, int(often.sum()), 2048):  # frequent values: products of slices of the membership matrix
        chosen = often[column] & (name[column] >= first) & (name[column] < first + 2048)
        part = np.zeros((n, 2048), dtype=np.float32)
        part[owner[chosen], name[column[chosen]] - first] = 1
        met += part[: cut or n] @ part[cut:].T
    rare = (counts[column] > 1) & ~often[column]
    order = np.argsort(column[rare], kind="stable")
    column, owner = column[rare][order], owner[rare][order]
    for step in range(1, 8):  # rare values: their few holders in turn, in ascending order
        same = np.flatnonzero(column[step:] == column[:-step])
        low, high = owner[same], owner[same + step]
        if cut:
            across = (low < cut) & (high >= cut)
            np.add.at(met, (low[across], high[across] - cut), 1)
        else:
            np.add.at(met, (low, high), 1)
            np.add.at(met, (high, low), 1)
    return met


def check_clouds(clouds: DataFrame, groups: DataFrame, texts: DataFrame, shingles, percent: int) -> DataFrame:
    """Links ``(a, b)`` that join the groups of a cloud (see :func:`bucket_clouds`).

    A cloud is dealt over its blocks, and each two blocks meet in one task, which compares the sets of one with those of
    the other, or of a block with its own, by exact intersection, and gives one link per item to the smallest one it is
    connected with there. So an item moves once per block of its cloud, a pair is compared once and never a row, and a
    task holds two blocks.
    """
    placed = clouds.withColumn("own", F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int"))
    placed = placed.join(groups, "item", "left").withColumn("group", F.coalesce("group", "item"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).join(texts, "item")
    dealt = dealt.select("cloud", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "item", "group", "text")

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("own")
        values, bounds = zip(*[shingles(part) for part in blocks.texts(table.column("text").combine_chunks())])
        lengths = np.concatenate([np.diff(b) for b in bounds])
        n, own = len(lengths), table.column("own").to_numpy()
        cut = int((own < table.column("y")[0].as_py()).sum())  # the items of the first of two blocks, else 0
        met = _meet(np.concatenate(values), np.concatenate([[0], np.cumsum(lengths)]), cut).astype(np.int64)
        linked = np.zeros((n, n), dtype=bool)
        near = 100 * met >= percent * (lengths[: cut or n, None] + lengths[None, cut:] - met)
        linked[: cut or n, cut:] = near
        linked[cut:, : cut or n] |= near.T
        item, group = table.column("item").to_numpy(), table.column("group").to_numpy()
        linked |= group[:, None] == group[None, :]
        label = np.arange(len(item))
        while True:  # the smallest place that a chain of links reaches
            low = np.where(linked, label[None, :], len(item)).min(axis=1)
            low = low[low]
            if np.array_equal(low, label):
                break
            label = low
        moved = group != group[label]
        return pa.table({"a": item[label[moved]], "b": item[moved]})

    return dealt.groupBy("cloud", "x", "y").applyInArrow(compare, "a bigint, b bigint")


def check_pairs(pairs: DataFrame, texts: DataFrame, shingles, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose shingle sets share at least ``percent`` of their union, by exact intersection.

    ``texts`` has ``item, text``, one row per item; ``shingles(block)`` gives the sets of a block of texts. The
    partners' texts move to their hub; a hub with many partners stands at several salts, with a thousand partners at
    each, so no task holds more than that of a hub.
    """
    spread = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).cast("int").alias("salts"))
    partners = (
        pairs.join(spread, "a")
        .withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int"))
        .join(texts.withColumnRenamed("item", "b"), "b")
        .select("a", "salt", "b", "text")
    )
    hubs = spread.select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")).join(texts.withColumnRenamed("item", "a"), "a")
    rows = partners.unionByName(hubs.select("a", "salt", F.lit(None).cast("bigint").alias("b"), "text"))
    dealt = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())

    def check(batches):
        hub, hub_of = np.zeros(0, np.uint64), None
        for batch in batches:
            own_hub = batch.column(0).to_numpy()
            alone = batch.column(1).is_null().to_numpy(zero_copy_only=False)
            found = []
            for part in blocks.texts(batch.column(2)):
                values, bounds = shingles(part)
                for i in range(len(part)):
                    own = values[bounds[i] : bounds[i + 1]]
                    if alone[part.first + i]:
                        hub, hub_of = own.copy(), own_hub[part.first + i]
                        continue
                    if own_hub[part.first + i] != hub_of:  # the hub has no text
                        continue
                    both = len(np.intersect1d(hub, own, assume_unique=True))
                    if 100 * both >= percent * (len(hub) + len(own) - both):
                        found.append(part.first + i)
            yield pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(found, pa.int64())) for k in (0, 1)], names=["a", "b"])

    return dealt.select("a", "b", "text").mapInArrow(check, "a bigint, b bigint")


def union_find(links: DataFrame) -> DataFrame:
    """Group ``(item, group)`` of each linked item; the group is its smallest item.

    Every round each item offers the smallest label among its neighbours to itself and to its own label, then takes
    the label of its label. Rounds grow with the logarithm of the longest path; each is written, so a lost executor
    costs its running tasks only, and the one before goes. It ends when a round changes nothing.
    """
    edges = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct()
    edges = cut_lineage(edges)
    labels = cut_lineage(edges.groupBy(F.col("a").alias("item")).agg(F.least(F.first("a"), F.min("b")).alias("group")))
    while True:
        near = edges.join(labels.withColumnRenamed("item", "b"), "b").groupBy(F.col("a").alias("item")).agg(F.min("group").alias("near"))
        offered = labels.join(near, "item")
        none = F.lit(None).cast("bigint").alias("before")
        offers = (
            offered.select("item", F.col("near").alias("group"), none)
            .unionByName(offered.select(F.col("group").alias("item"), F.col("near").alias("group"), none))
            .unionByName(labels.withColumn("before", F.col("group")))
        )
        hooked = offers.groupBy("item").agg(F.min("group").alias("group"), F.max("before").alias("before"))
        above = hooked.select(F.col("item").alias("group"), F.col("group").alias("above"))
        now = cut_lineage(hooked.join(above, "group").select("item", F.col("above").alias("group"), "before"))
        moved = now.filter("group <> before").limit(1).count()
        discard(labels)
        labels = now.select("item", "group")
        if not moved:
            discard(edges)
            return labels


def check_mixed(mixed: DataFrame, groups: DataFrame, checked: DataFrame, texts: DataFrame, shingles, percent: int) -> DataFrame:
    """Links ``(a, b)`` among all pairs that share a bucket of two groups or more, but for the ``checked`` ones.

    Clouds of a few blocks are compared in full. A chain of small buckets can tie most of the items together, whose blocks
    would all have to meet; so in larger clouds small buckets give their pairs, at most ``PAIRED / 2`` for each place in
    one, and only the large buckets are put together into clouds and compared by blocks.
    """
    clouds = bucket_clouds(mixed)
    found = [cut_lineage(check_clouds(clouds.filter(F.col("blocks") <= CLOSE), groups, texts, shingles, percent))]
    wide = cut_lineage(mixed.join(clouds.filter(F.col("blocks") > CLOSE).select("item"), "item", "left_semi"))
    if wide.limit(1).count():
        pairs = cut_lineage(open_pairs(wide.filter(F.col("items") <= PAIRED), percent).join(checked, ["a", "b"], "left_anti"))
        found.append(cut_lineage(check_pairs(pairs, texts, shingles, percent)))
        large = bucket_clouds(wide.filter(F.col("items") > PAIRED))
        found.append(cut_lineage(check_clouds(large, groups, texts, shingles, percent)))
    return reduce(DataFrame.unionByName, found)


def link_items(items: DataFrame, texts_of, shingles, percent: int, buckets=bucket_members) -> DataFrame:
    """Groups ``(item, group)`` of the items linked by a chain of pairs that share ``percent`` of their union.

    ``items`` has ``item``, ``size`` (of its set) and ``bands``; copies may repeat. ``texts_of(wanted)`` gives
    ``(item, text)`` for a table of items, and ``shingles`` the sets of a block of texts. First every item is checked
    against one hub, which settles most copies; ``buckets`` finds those that meet. Then the buckets that still hold several groups are compared in full
    by :func:`check_mixed`, so every pair that shares a bucket is decided. What is written on the way goes at the end.
    """
    with scratch(items.sparkSession) as keep:
        members = buckets(items)
        texts = cut_lineage(texts_of(members.select("item").distinct()))
        hubs = cut_lineage(hub_pairs(members, percent))
        links = cut_lineage(check_pairs(hubs, texts, shingles, percent))
        groups = union_find(links)
        mixed = mixed_buckets(members, groups)
        more = check_mixed(mixed, groups, hubs, texts, shingles, percent)
        return keep(groups if more.limit(1).count() == 0 else union_find(links.unionByName(more)))
