"""Writers. Only this module and `state` put data on disk."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martworks.operators.upsert import upsert
from martworks.session import reliable, run_dir
from martworks.sources.state import WatermarkStore


def write_mart(df: DataFrame, root: str, name: str, mode: str = "errorifexists", partition_by: list[str] = ()) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{root}/{name}")


def write_snapshot(df: DataFrame, path: str) -> None:
    """Replace one snapshot by the rows of a micro-batch."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def full_refresh(df: DataFrame, root: str, name: str, state: WatermarkStore) -> str:
    """Reload a table: write a new folder, then switch the recorded version.

    Readers keep the old version until the switch, and the new rows may be
    computed from the old ones, which an overwrite in place would destroy.
    """
    path = run_dir_for(df.sparkSession, root, name)
    df.write.parquet(path)
    state.save(f"table:{root}/{name}", path)
    return path


def run_dir_for(spark: SparkSession, root: str, name: str) -> str:
    return f"{root}/{name}/{run_dir(spark, 'run').rsplit('/', 1)[1]}"


def read_refreshed(spark: SparkSession, root: str, name: str, state: WatermarkStore) -> DataFrame:
    return spark.read.parquet(state.get(f"table:{root}/{name}"))


def replace_partition(df: DataFrame, path: str, *partition_cols: str) -> None:
    """Overwrite only the partitions present in `df`; a rerun gives the same table."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols).parquet(path)


def bucket_of(keys: list[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def write_bucketed(df: DataFrame, path: str, keys: list[str], n: int) -> None:
    """First load of a table kept in key buckets, one folder per bucket; the count is kept beside it."""
    df.sparkSession.createDataFrame([(n,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(f"{path}.buckets")
    df.withColumn("bucket", bucket_of(keys, n)).write.mode("errorifexists").partitionBy("bucket").parquet(path)


def upsert_table(spark: SparkSession, path: str, source: DataFrame, keys: list[str], update_cols: list[str],
                 n: int, order: list[str] | None = None) -> None:
    """Upsert into a bucketed table by rewriting only the touched buckets.

    The merged rows are fixed in the shared folder before the old files go, so
    a lost executor cannot leave a bucket half written from deleted input. The
    source is fixed too, as it is read twice. Another bucket count than the
    table was made with is an error.
    """
    made_with = spark.read.parquet(f"{path}.buckets").first().buckets
    if n != made_with:
        raise ValueError(f"{path} has {made_with} buckets, not {n}")
    batch = reliable(source).withColumn("bucket", bucket_of(keys, n))
    touched = [r.bucket for r in batch.select("bucket").distinct().collect()]  # at most n numbers
    if not touched:
        return
    old = spark.read.parquet(path).where(F.col("bucket").isin(touched))
    merged = reliable(upsert(old, batch.select(*[c for c in old.columns], *[c for c in (order or []) if c not in old.columns]),
                             ["bucket", *keys], update_cols, order))
    replace_partition(merged, path, "bucket")


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_layout(df: DataFrame, table: str, partition_by: Column | None, bucket_by: list[str], sort_by: list[str],
                 buckets: int, partition_name: str = "part") -> None:
    """Partitioned, hash-bucketed and sorted table, so that later joins and
    groupings on the bucket key need no shuffle."""
    rows = df.withColumn(partition_name, partition_by) if partition_by is not None else df
    # one task per bucket keeps the number of files at buckets x partitions
    writer = rows.repartition(buckets, *bucket_by).write.mode("overwrite").format("parquet")
    if partition_by is not None:
        writer = writer.partitionBy(partition_name)
    writer.bucketBy(buckets, *bucket_by).sortBy(*sort_by).saveAsTable(table)


def fan_out(*sinks: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """One micro-batch to several sinks: computed once, released at the end."""
    def write(df: DataFrame, batch_id: int) -> None:
        kept = df.persist()
        try:
            for sink in sinks:
                sink(kept, batch_id)
        finally:
            kept.unpersist()
    return write
