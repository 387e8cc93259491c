"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math
import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martworks.session import reliable

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ready(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package when the repository is not installed on them."""
    env, have = spark.sparkContext.environment, spark.sparkContext.environment.get("PYTHONPATH", "")
    if _ROOT not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (_ROOT, have) if x)
    return spark


def staged(df: DataFrame) -> DataFrame:
    """`reliable` with the session's codec."""
    return reliable(df, codec=None)


# bytes of an Arrow batch; Spark's own bound, 64 MB, is held several times over by a task and its Python worker
BATCH_BYTES = 8 << 20


def short_batches(spark: SparkSession) -> SparkSession:
    """From now on long texts reach the Python workers of this session in batches of about BATCH_BYTES, unless less was set."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
    if not 0 < size <= BATCH_BYTES:
        spark.conf.set(name, f"{BATCH_BYTES}b")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, n: int) -> Column:
    """crc32 of the key as text, mod n; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): each node of the undirected links (u, v) with the smallest node it reaches.

    Large-star and small-star rounds: links are moved to the smallest
    neighbour until they form stars, in a number of rounds that grows with the
    logarithm of the longest path. Each round is a written table; only a
    count and a checksum reach the driver. Self links and nulls are left out.
    """
    links = staged(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    for _ in range(rounds):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # written, because the next step reads it three times
        large = staged(large.where("u <> v").distinct())
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        links = staged(
            large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        now = tuple(links.agg(F.count("*"), F.coalesce(
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"links did not settle in {rounds} rounds")
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


class Forest:
    """Union-find over the positions of one task's block; roots are the smallest positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def link(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def block_pairs(members: DataFrame, weight: str, target: float) -> DataFrame:
    """Deals the members of each `grp` to pairs of blocks (i <= j), so that every
    pair of members meets in exactly one task-sized piece.

    Members get a block by hash of `id`; a group has ceil(sum(weight) / target)
    blocks. Adds `i`, `j` and `side` (-1: i = j, 0: from block i, 1: from block j).
    """
    sizes = members.groupBy("grp").agg(F.ceil(F.sum(weight) / F.lit(float(target))).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = members.join(sizes, "grp").withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return dealt.withColumn("other", other).select(
        *members.columns, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        F.when(F.col("own") == F.col("other"), -1).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"))


def logit(p: float) -> float:
    return math.log(p / (1 - p))
