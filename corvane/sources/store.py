"""The chunk store: partitioned Parquet by dataset, rewritten partition by partition."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.functions import scalars as sc
from corvane.session import cut_lineage

PARTS = ("dataset_id", "bucket")


def stored_chunks(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows of a store with their ``bucket``, or None where there is no store. Dataset ids stay text."""
    try:
        found = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    fields = [T.StructField(f.name, T.StringType() if f.name in PARTS else f.dataType, True) for f in found.schema.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def read_chunks(spark: SparkSession, path: str, datasets: Sequence[str] | None = None) -> DataFrame:
    """Chunks of some datasets; other partitions are not touched."""
    chunks = stored_chunks(spark, path)
    if chunks is None:
        raise ValueError(f"no chunk store at {path}")
    chunks = chunks.drop("bucket")
    return chunks if datasets is None else chunks.filter(F.col("dataset_id").isin(*datasets))


def latest_by_id(rows: DataFrame, key: str = "chunk_id", order: str | Column = "version") -> DataFrame:
    """One row per id, the last one by ``order``; combines on the map side."""
    others = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("_r")).select(key, "_r.*").select(*rows.columns)


def write_chunks(new: DataFrame, path: str, key: str = "chunk_id", order: str | None = None, bucket_rows: int = 1_000_000) -> None:
    """Upsert chunks into the store by id, whatever dataset an id stood in before.

    With ``order`` the row of largest order stays, of new and stored rows alike (of equal ones the new row); without it
    the new rows must have distinct ids and replace stored ones. The store is cut by dataset and by a bucket of the id.
    Only the cuts that hold or get one of the ids are rewritten, and those that lose their last row are removed. The
    number of buckets doubles, in one rewrite of the store, when they hold more than twice ``bucket_rows`` rows.
    """
    spark = new.sparkSession
    rows = new.withColumn("dataset_id", F.col("dataset_id").cast("string"))
    fresh = cut_lineage(rows if order is None else latest_by_id(rows, key, order))
    count = fresh.count()
    if order is None and fresh.select(key).distinct().count() < count:
        raise ValueError("an order column is needed where ids repeat")
    stored = stored_chunks(spark, path)
    first = None if stored is None else stored.select("bucket").first()
    if first is None:
        buckets, touched, merged = max(1, -(-count // bucket_rows)), [], fresh
    else:
        held = int(first[0].partition("of")[2])
        buckets = held
        while stored.count() + count > 2 * buckets * bucket_rows:
            buckets *= 2
        old = stored
        if buckets == held:
            named = fresh.select("dataset_id", _bucket(key, buckets).alias("bucket"))
            met = stored.join(fresh.select(key), key, "left_semi").select(*PARTS)
            touched = [tuple(r) for r in named.unionByName(met).distinct().collect()]  # cuts of the store
            keys = spark.createDataFrame(touched, "dataset_id string, bucket string")
            same = stored["dataset_id"].eqNullSafe(keys["dataset_id"]) & (stored["bucket"] == keys["bucket"])
            old = stored.filter(F.col("bucket").isin(*{b for _, b in touched})).join(F.broadcast(keys), same, "left_semi")
        else:
            touched = [tuple(r) for r in stored.select(*PARTS).distinct().collect()]
        both = old.drop("bucket").withColumn("_new", F.lit(0)).unionByName(fresh.withColumn("_new", F.lit(1)), allowMissingColumns=True)
        last = F.struct("_new") if order is None else F.struct(order, "_new")
        merged = cut_lineage(latest_by_id(both, key, last).drop("_new"))
    placed = merged.withColumn("bucket", _bucket(key, buckets))
    placed.repartition(*PARTS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTS).parquet(path)
    left = {tuple(r) for r in placed.select(*PARTS).distinct().collect()} if touched else set()
    for dataset, bucket in touched:
        if (dataset, bucket) not in left:
            _remove_cut(spark, path, dataset, bucket)


def _bucket(key: str, buckets: int) -> Column:
    return F.concat(F.lpad(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("string"), 6, "0"), F.lit(f"of{buckets}"))


def _remove_cut(spark: SparkSession, path: str, dataset: str | None, bucket: str) -> None:
    """Delete the folder of a cut that has no rows left."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    name = "__HIVE_DEFAULT_PARTITION__" if dataset in (None, "") else escape(dataset)
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/dataset_id={name}/bucket={bucket}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def remove_first(values: Column, item: Column) -> Column:
    """Array without the first occurrence of an element."""
    at = F.array_position(values, item).cast("int")
    rest = F.concat(F.slice(values, F.lit(1), at - 1), F.slice(values, at + 1, F.size(values)))
    return F.when(at > 0, rest).otherwise(values)


def update_chunks(
    chunks: DataFrame,
    condition: Column,
    set_: Mapping[str, Column] | None = None,
    append: Mapping[str, Column] | None = None,
    remove: Mapping[str, Column] | None = None,
    drop: Sequence[str] = (),
) -> DataFrame:
    """Change rows that meet a condition: set a field, append to or take one element from an array, empty a field.

    Feature maps are set, so they are replaced and never merged.
    """
    hit = F.coalesce(condition, F.lit(False))
    new = {}
    for name, value in (set_ or {}).items():
        new[name] = value
    for name, value in (append or {}).items():
        new[name] = F.array_append(F.coalesce(F.col(name), F.array().cast(chunks.schema[name].dataType)), value)
    for name, value in (remove or {}).items():
        new[name] = remove_first(F.col(name), value)
    for name in drop:
        new[name] = F.lit(None).cast(chunks.schema[name].dataType)
    return chunks.withColumns({name: F.when(hit, value).otherwise(F.col(name)) for name, value in new.items()})


def delete_chunks(chunks: DataFrame, condition: Column) -> DataFrame:
    """Rows that do not meet a condition; an unknown result keeps the row."""
    return chunks.filter(~F.coalesce(condition, F.lit(False)))


def get_by_id(chunks: DataFrame, ids: DataFrame, columns: Sequence[str], key: str = "chunk_id") -> DataFrame:
    """Chosen columns of the rows with given ids."""
    return chunks.select(key, *columns).join(ids.select(key).distinct(), key, "left_semi")


def vectors_by_id(chunks: DataFrame, ids: DataFrame, dim: int, key: str = "chunk_id", vector: str = "embedding") -> DataFrame:
    """Vectors of given ids; a vector of another dimension becomes zeros."""
    return get_by_id(chunks, ids, [vector], key).withColumn(vector, sc.fixed_dimension(F.col(vector), dim))
