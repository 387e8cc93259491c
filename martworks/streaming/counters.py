"""Running counters of distinct orders per user and product or category."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from martworks.plans.order_vault import message_categories, message_products
from martworks.session import reliable, staging
from martworks.sources.runs import BUCKETS, FAN, RunStore
from martworks.streaming.sinks import start


class CounterStore:
    """Order keys that were counted, and what every batch added to the counters.

    A batch is compared with the order keys in the buckets it touches, so an
    order counts once however late it comes or is sent again, and no stream state
    grows. Counters are added up when they are read and when runs are merged;
    a batch that is repeated adds what a failure left out.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, label: str, kinds: dict[str, T.DataType],
                 buckets: int = BUCKETS, fan: int = FAN):
        self.identity, self.counter, self.label = ["user_id", key, "order_id"], ["user_id", key], label
        fields = {name: T.StructField(name, kind) for name, kind in kinds.items()}
        count = T.StructField("order_cnt", T.LongType())
        self.orders = RunStore(spark, f"{path}/orders", T.StructType([fields[c] for c in self.identity]), self.identity, buckets, fan)
        self.counts = RunStore(spark, f"{path}/counts", T.StructType([*[fields[c] for c in self.counter], fields[label], count]),
                               self.counter, buckets, fan, self._added)

    def _added(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.counter).agg(F.max(self.label).alias(self.label), F.sum("order_cnt").alias("order_cnt"))

    def add(self, df: DataFrame, batch_id: int) -> None:
        if self.orders.holds(batch_id):
            return
        same = [F.col(f"n.{c}").eqNullSafe(F.col(f"k.{c}")) for c in self.identity]
        with staging(self.orders.spark):
            rows = reliable(df.groupBy(*self.identity).agg(F.max(self.label).alias(self.label)))
            fresh = rows
            if self.orders.manifest().runs:
                fresh = reliable(rows.alias("n").join(self.orders.near(rows).alias("k"), same, "left_anti"))
            # the order keys close the batch: before them nothing of it is known, so it can be computed again
            self.counts.append(self._added(fresh.withColumn("order_cnt", F.lit(1).cast("long"))), batch_id)
            self.orders.append(fresh, batch_id)


def counter_writer(path: str, key: str, label: str, buckets: int = BUCKETS, fan: int = FAN) -> Callable[[DataFrame, int], None]:
    """`foreachBatch` function over rows of (user_id, key, order_id, label)."""
    def write(df: DataFrame, batch_id: int) -> None:
        kinds = {f.name: f.dataType for f in df.schema}
        CounterStore(df.sparkSession, path, key, label, kinds, buckets, fan).add(df, batch_id)
    return write


def run_counters(messages: DataFrame, kind: str, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Stream of user messages to a store of counts (`kind`: product or category)."""
    explode = {"product": message_products, "category": message_categories}[kind]
    return start(explode(messages), counter_writer(path, f"{kind}_id", f"{kind}_name"), checkpoint, every=every)


def read_counters(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Distinct orders per (user, key)."""
    kinds = {"user_id": T.StringType(), f"{kind}_id": T.StringType(), f"{kind}_name": T.StringType(), "order_id": T.LongType()}
    return CounterStore(spark, path, f"{kind}_id", f"{kind}_name", kinds).counts.read()
