"""A stored graph that grows by increments: edges upserted by cut, texts appended, page rank refreshed by residuals.

The store keeps each undirected edge in both directions, cut by its first end, and per vertex its strength (sum of edge
weights), an estimate and a residual of its rank. An increment rewrites the cuts that hold one of its vertices, corrects the
residuals of their neighbours by what their links changed, and pushes residuals along the links until all are small: the
work follows the change and not the graph. A manifest is written last, so readers see an increment whole or not at all, and
an increment that comes again starts from the manifest before it and writes the same.

Ranks solve y = 1 + damping * (links into a vertex) y, of which page rank is a multiple: an isolated vertex has y = 1, and
the rank it spreads evenly, like the number of vertices, only changes the multiple. So new vertices touch no other rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.session import cut_lineage

EDGE = "src string, dst string, weight double, mentions bigint"
VERTEX = "name string, strength double, y double, r double"
TEXT = "src string, dst string, description string, keywords string, source_id string"


class GraphStore:
    """A graph in ``folder`` of ``cuts`` cuts; ``tolerance`` bounds every residual, ``stride`` steps are one job."""

    def __init__(self, spark: SparkSession, folder: str, cuts: int = 16, damping: float = 0.85, tolerance: float = 2e-7, stride: int = 16):
        self.spark, self.folder, self.cuts = spark, folder.rstrip("/"), cuts
        self.damping, self.tolerance, self.stride = damping, tolerance, stride

    def _cut(self, column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(self.cuts)).cast("int")

    def _manifest(self, below: int | None = None) -> list:
        """``(part, cut, n)`` of the last increment, or of the last one with a number under ``below``."""
        names = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        try:
            files = names.load(f"{self.folder}/manifest").select(F.regexp_extract("path", r"/n=(\d+)/", 1).cast("int").alias("n"))
            found = files.filter(F.lit(True) if below is None else F.col("n") < below).agg(F.max("n")).first()[0]
        except Exception as error:  # the first increment finds no folder
            if "PATH_NOT_FOUND" not in str(error):
                raise
            found = None
        return [] if found is None else self.spark.read.parquet(f"{self.folder}/manifest/n={found}").collect()

    def _read(self, part: str, schema: str, manifest: list, cuts: set[int] | None = None) -> DataFrame:
        paths = [f"{self.folder}/{part}/n={m.n}/cut={m.cut}" for m in manifest if m.part == part and (cuts is None or m.cut in cuts)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def edges(self, manifest: list | None = None) -> DataFrame:
        """Each undirected edge once: ``src, dst, weight, mentions``."""
        return self._read("edges", EDGE, self._manifest() if manifest is None else manifest).filter("src <= dst")

    def texts(self) -> DataFrame:
        """The long table of all that was said of an edge: ``src, dst, n, description, keywords, source_id``."""
        done = {m.n for m in self._manifest() if m.part == "texts"}
        return self.spark.read.schema(f"{TEXT}, n int").parquet(f"{self.folder}/texts").filter(F.col("n").isin(list(done)))

    def ranks(self, isolated: int = 0) -> DataFrame:
        """``name, pagerank`` of all vertices with an edge; ``isolated`` further vertices share what is theirs."""
        vertices = self._read("vertices", VERTEX, self._manifest())
        n = vertices.count() + isolated
        return vertices.select("name", (F.col("y") * ((1 - self.damping) / max(n - self.damping * isolated, 1))).alias("pagerank"))

    def apply(self, mentions: DataFrame, n: int) -> None:
        """Increment ``n``: mentions ``src, dst, weight``, and ``description, keywords, source_id`` if there are any.

        Rows without an end are left out; null weights count as 0. The direction of an edge has no meaning.
        """
        before = self._manifest(below=n)
        known = [F.col(c).cast("string").alias(c) if c in mentions.columns else F.lit(None).cast("string").alias(c) for c in ("description", "keywords", "source_id")]
        weight = F.coalesce(F.col("weight").cast("double"), F.lit(0.0)).alias("weight")
        rows = mentions.filter("src IS NOT NULL AND dst IS NOT NULL").select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"), weight, *known)
        said = f"{self.folder}/texts/n={n}"
        rows.write.mode("overwrite").parquet(said)
        rows = self.spark.read.parquet(said)
        if rows.isEmpty():
            return
        summed = rows.groupBy("src", "dst").agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("mentions"))
        both = summed.unionByName(summed.filter("src <> dst").select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight", "mentions"))
        fresh = cut_lineage(both.withColumn("cut", self._cut("src")))
        touched = {r.cut for r in fresh.select("cut").distinct().collect()}

        old = self._read("edges", EDGE, before, touched)
        merged = old.unionByName(fresh.drop("cut")).groupBy("src", "dst").agg(F.sum("weight").alias("weight"), F.sum("mentions").alias("mentions"))
        target = f"{self.folder}/edges/n={n}"
        merged.withColumn("cut", self._cut("src")).repartition(4 * len(touched), "cut", F.pmod(F.xxhash64("dst"), F.lit(4))).write.mode("overwrite").partitionBy("cut").parquet(target)
        after = [m for m in before if m.part == "edges" and m.cut not in touched] + [self._row("edges", c, n) for c in touched]

        gained = fresh.groupBy(F.col("src").alias("name")).agg(F.sum("weight").alias("gain"))
        vertices = self._read("vertices", VERTEX, before)
        state = cut_lineage(
            vertices.join(gained, "name", "full").select(
                "name", (F.coalesce("strength", F.lit(0.0)) + F.coalesce("gain", F.lit(0.0))).alias("strength"), F.coalesce("strength", F.lit(0.0)).alias("was"),
                F.coalesce("y", F.lit(0.0)).alias("y"), F.coalesce("r", F.lit(1.0)).alias("r"), F.col("gain").isNotNull().alias("touched"),
            )
        )
        state = cut_lineage(self._pushed(self._corrected(state, self._read("edges", EDGE, after, touched), fresh), after))
        state.withColumn("cut", self._cut("name")).repartition(self.cuts, "cut").write.mode("overwrite").partitionBy("cut").parquet(f"{self.folder}/vertices/n={n}")
        cuts = [r.cut for r in state.select(self._cut("name").alias("cut")).distinct().collect()]
        after += [self._row("vertices", c, n) for c in cuts]
        after += [m for m in before if m.part == "texts"] + [self._row("texts", 0, n)]
        self.spark.createDataFrame(after).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/manifest/n={n}")

    @staticmethod
    def _row(part: str, cut: int, n: int):
        from pyspark.sql import Row

        return Row(part=part, cut=cut, n=n)

    def _corrected(self, state: DataFrame, edges: DataFrame, fresh: DataFrame) -> DataFrame:
        """Residuals after the links of touched vertices changed under their estimates."""
        moved = state.filter("touched AND y <> 0").select(F.col("name").alias("src"), "y", "strength", "was")
        gain = fresh.select("src", "dst", F.col("weight").alias("gain"))
        now = edges.join(moved, "src").join(gain, ["src", "dst"], "left").withColumn("gain", F.coalesce("gain", F.lit(0.0)))
        share = lambda w, s: F.when(s > 0, w / s).otherwise(0.0)
        change = share(F.col("weight"), F.col("strength")) - share(F.col("weight") - F.col("gain"), F.col("was"))
        turned = now.groupBy(F.col("dst").alias("name")).agg(F.sum(self.damping * F.col("y") * change).alias("turn"))
        return state.join(turned, "name", "left").select("name", "strength", "y", (F.col("r") + F.coalesce("turn", F.lit(0.0))).alias("r"))

    def _pushed(self, state: DataFrame, manifest: list, most: int = 200) -> DataFrame:
        """Estimates whose residuals are all within the tolerance."""
        for _ in range(most):
            state = cut_lineage(state)
            large = F.abs("r") > self.tolerance
            active = state.filter(large).select("name", "r")
            cuts = {r.cut for r in active.select(self._cut("name").alias("cut")).distinct().collect()}
            if not cuts:
                return state
            strength = state.filter("strength > 0").select(F.col("name").alias("src"), "strength")
            share = (F.col("weight") / F.col("strength") * self.damping).alias("share")
            mine, links = (self._read("edges", EDGE, manifest, of).join(strength, "src").select("src", "dst", share) for of in (cuts, None))
            wave, added = active.withColumnRenamed("r", "v"), None
            for step in range(self.stride):
                part = wave.select("name", F.col("v").alias("dy"), F.lit(0.0).alias("dr"))
                added = part if added is None else added.unionByName(part)
                along = (mine if step == 0 else links).join(wave.withColumnRenamed("name", "src"), "src")
                wave = along.groupBy(F.col("dst").alias("name")).agg(F.sum(F.col("v") * F.col("share")).alias("v"))
            added = added.unionByName(wave.select("name", F.lit(0.0).alias("dy"), F.col("v").alias("dr")))
            sums = added.groupBy("name").agg(F.sum("dy").alias("dy"), F.sum("dr").alias("dr"))
            state = state.join(sums, "name", "left").select(
                "name", "strength", (F.col("y") + F.coalesce("dy", F.lit(0.0))).alias("y"),
                (F.when(large, 0.0).otherwise(F.col("r")) + F.coalesce("dr", F.lit(0.0))).alias("r"),
            )
        raise RuntimeError("residuals did not settle")


def follow(stream: DataFrame, store: GraphStore, checkpoint: str) -> None:
    """Relation mentions of new documents into the stored graph, one increment for each micro-batch."""
    from corvane.streaming.ingest import run_available

    run_available(stream, store.apply, checkpoint)
