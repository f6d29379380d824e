"""Clustering and summary trees over the given vectors (H ids)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.operators import cluster
from corvane.plans import inputs as inp
from corvane.plans.registry import query, table
from corvane.session import cut_lineage


def vectors(spark, folder):
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))


@query("h1_reduce_dims")
def h1_reduce_dims(spark, folder):
    return cluster.reduce_dims(vectors(spark, folder), 12).select("id", F.size("vector").alias("dim"))


@query("h2_cluster_gmm")
def h2_cluster_gmm(spark, folder):
    low = cluster.reduce_dims(vectors(spark, folder), 8)
    return cluster.cluster_gmm(low, 6)


@query("h3_cluster_ward")
def h3_cluster_ward(spark, folder):
    """Forty vectors at a time are taken for the chunks of one document."""
    return cluster.cluster_ward(vectors(spark, folder).withColumn("doc", F.floor(F.col("id") / 40)), 16, "doc")


@query("h3_cluster_dataset")
def h3_cluster_dataset(spark, folder):
    return cluster.cluster_dataset(vectors(spark, folder), 16)


@query("h3_nearest_centre", "SELECT vec_id AS id, true AS nearest FROM embeddings")
def h3_nearest_centre(spark, folder):
    """Whether a vector is as near to the mean of its cluster as to any other, within a thousandth, after enough moves."""
    rows = vectors(spark, folder)
    labels = cut_lineage(cluster.cluster_dataset(rows, 16, refine=60).join(rows, "id"))
    means = cluster.mean_vectors(labels, ["cluster"])
    held = F.array_sort(F.collect_list(F.struct("cluster", F.col("vector").alias("m"))))
    far = lambda m: F.aggregate(F.zip_with("vector", m, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    every = labels.withColumn("means", means.agg(held.alias("m")).scalar())
    own = F.filter("means", lambda e: e["cluster"] == F.col("cluster"))
    return every.select("id", (far(F.get(own, F.lit(0))["m"]) <= F.array_min(F.transform("means", lambda e: far(e["m"]))) + 1e-3).alias("nearest"))


@query("h4_summary_layers")
def h4_summary_layers(spark, folder):
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    layers = cluster.summary_layers(docs.join(vectors(spark, folder), "id"), 32)
    return layers.select("layer", "node", "parent")


@query("h5_pair_tree")
def h5_pair_tree(spark, folder):
    buckets = cluster.split_buckets(vectors(spark, folder), 256)
    return cluster.pair_tree(buckets)


@query(
    "h6_split_buckets",
    "SELECT vec_id AS id, true AS fits FROM embeddings",
)
def h6_split_buckets(spark, folder):
    """Every vector is in one bucket within the size."""
    buckets = cluster.split_buckets(vectors(spark, folder), 100)
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    return buckets.join(sizes, "bucket").select("id", (F.col("n") <= 100).alias("fits"))


@query("h7_bucketed_tree")
def h7_bucketed_tree(spark, folder):
    return cluster.bucketed_tree(vectors(spark, folder), 64)


FLAT_SQL = """rows AS (SELECT 'S' || s_suppkey AS node, 'N' || s_nationkey AS parent FROM supplier UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey FROM nation)"""


@query("h8_rebalance")
def h8_rebalance(spark, folder):
    """Customers below nations below regions, at most five children each."""
    customers = table(spark, folder, "customer").select(F.concat(F.lit("C"), "c_custkey").alias("node"), F.concat(F.lit("N"), "c_nationkey").alias("parent"))
    nations = table(spark, folder, "nation").select(F.concat(F.lit("N"), "n_nationkey").alias("node"), F.concat(F.lit("R"), "n_regionkey").alias("parent"))
    return cluster.rebalance(customers.unionByName(nations), 5)


@query(
    "h8_prototypes",
    """
WITH v AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS p FROM embeddings),
l AS (SELECT label, p, avg(x) AS x FROM v GROUP BY label, p), r AS (SELECT label % 2 AS side, p, avg(x) AS x FROM l GROUP BY 1, 2)
SELECT 'L' || label AS node, round(sum(x), 6) AS total FROM l GROUP BY label
UNION ALL SELECT 'T' || side, round(sum(x), 6) FROM r GROUP BY side
""",
)
def h8_prototypes(spark, folder):
    rows = table(spark, folder, "embeddings")
    leaf = F.concat(F.lit("V"), F.col("vec_id").cast("string"))
    label = F.concat(F.lit("L"), F.col("label").cast("string"))
    side = F.concat(F.lit("T"), (F.col("label") % 2).cast("string"))
    tree = rows.select(leaf.alias("node"), label.alias("parent")).unionByName(rows.select(label.alias("node"), side.alias("parent")).distinct())
    nodes = cluster.prototypes(tree, rows.select(leaf.alias("node"), F.col("embedding").cast("array<double>").alias("vector")))
    return nodes.filter("node NOT LIKE 'V%'").select("node", F.aggregate("vector", F.lit(0.0), lambda s, x: s + x).alias("total"))


@query(
    "h9_summary_rows",
    """
SELECT 'row' AS kind, md5(text || chr(1) || 'dataset' || chr(1) || 'tree') AS chunk_id, CAST(1 + doc_id % 3 AS BIGINT) AS layer FROM documents
UNION ALL SELECT 'stale', md5('old' || doc_id), NULL FROM documents
""",
)
def h9_summary_rows(spark, folder):
    docs = table(spark, folder, "documents")
    layers = docs.select((1 + F.col("doc_id") % 3).cast("int").alias("layer"), "text")
    current = cluster.summary_rows(layers, None, "tree")
    stored = current.select("chunk_id", "doc_id").unionByName(
        docs.select(F.md5(F.concat(F.lit("old"), F.col("doc_id").cast("string"))).alias("chunk_id"), F.lit(None).cast("string").alias("doc_id"))
    )
    stale = cluster.stale_summaries(stored, current)
    return current.select(F.lit("row").alias("kind"), "chunk_id", "layer").unionByName(
        stale.select(F.lit("stale").alias("kind"), "chunk_id", F.lit(None).cast("int").alias("layer"))
    )
