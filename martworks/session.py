"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "martworks", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library defaults; keyword `conf` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# folder made for a local application that names none, by application id
_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    A machine-local folder is made only for a local master; on a cluster a
    missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="martworks-")
    return _local_dirs[context.applicationId]


def run_dir(spark: SparkSession, label: str) -> str:
    """A new, unused directory name under the shared folder.

    Names start with the application id, so what an application left behind
    can be found and removed when it has ended.
    """
    return f"{shared_dir(spark)}/martworks-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def lean_writes(spark: SparkSession) -> Iterator[None]:
    """Tables written inside the block leave no shuffle files behind: they go when the write is complete.

    Otherwise they stay until the driver collects its garbage, which may be never.
    """
    before = spark.conf.get(_SHUFFLE_CLEANUP, "false")
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLE_CLEANUP, before)


def write_table(df: DataFrame, path: str, *parts: str, codec: str | None = "zstd") -> None:
    """Writes a table in place of what is there. Texts of hashes hardly shrink with the session's default codec."""
    with lean_writes(df.sparkSession):
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*parts)
        (writer.option("compression", codec) if codec else writer).parquet(path)


class _Scopes(threading.local):
    """The open `staging` blocks of a thread, innermost last: paths to remove."""

    def __init__(self):
        self.open: list[list[str]] = []


_scopes = _Scopes()


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables that `reliable` writes inside the block, in this thread, are removed at its end.

    For the steps of a load that ends in a store: what it staged on the way is of no
    use after that. Gives a `reliable` for a table that outlives the block.
    """
    paths: list[str] = []

    def keep(df: DataFrame) -> DataFrame:
        kept = _stage(df)
        if len(_scopes.open) > 1:
            _scopes.open[-2].append(kept[1])
        return kept[0]

    _scopes.open.append(paths)
    try:
        yield keep
    finally:
        _scopes.open.pop()
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _stage(df: DataFrame, codec: str | None = "zstd") -> tuple[DataFrame, str]:
    path = run_dir(df.sparkSession, "stage")
    write_table(df, path, codec=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def reliable(df: DataFrame, codec: str | None = "zstd") -> DataFrame:
    """The rows as a table written to the shared folder: later passes read one
    fixed copy, also after executors were lost.

    A written table rather than a checkpoint, because it is read by column and
    its size is known when Spark chooses between broadcast and shuffle. Its
    shuffle files are removed at once, the table itself at the end of the
    innermost `staging` block, if there is one.
    """
    table, path = _stage(df, codec)
    if _scopes.open:
        _scopes.open[-1].append(path)
    return table


def work_partitions(spark: SparkSession) -> int:
    """Partition count for range layouts: the session's shuffle setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
