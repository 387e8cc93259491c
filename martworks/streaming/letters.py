"""Messages that could not be used: malformed ones, and orders that wait for a dimension row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martworks import schemas
from martworks.plans.order_vault import as_message, missing_keys
from martworks.session import reliable
from martworks.sources.runs import BUCKETS, RunStore

_BAD = "_corrupt"


def read_messages(df: DataFrame, schema: str, required: str) -> DataFrame:
    """The columns of `df` with `value` (text), `reason` and the fields of the message.

    reason is null for a usable message, `empty` for a null or blank one,
    `malformed` for text that is no JSON object or whose fields have other types
    than the schema says, `no <required>` if that field is missing. No row is left out.
    """
    value = F.col("value").cast("string")
    how = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    parsed = df.withColumn("value", value).withColumn("_m", F.from_json("value", f"{schema}, {_BAD} string", how))
    m = F.col("_m")
    reason = (F.when(F.coalesce(F.trim("value"), F.lit("")) == "", "empty").when(m[_BAD].isNotNull() | m.isNull(), "malformed")
              .when(m[required].isNull(), f"no {required}"))
    fields = [f for f in parsed.schema["_m"].dataType.fieldNames() if f != _BAD]
    return parsed.select(*df.columns, reason.alias("reason"), *[m[f].alias(f) for f in fields])


class DeadLetters:
    """Malformed messages by their text: value, reason, how often each batch had it."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.store = RunStore(spark, path, "value string, reason string, n long", ["value"], buckets)

    def keep(self, messages: DataFrame, batch_id: int, source: str = "stream") -> bool:
        """Stores the messages that have a reason."""
        bad = messages.where(F.col("reason").isNotNull()).groupBy("value", "reason").agg(F.count("*").alias("n"))
        return self.store.append(bad, batch_id, source)

    def read(self) -> DataFrame:
        return self.store.read().groupBy("value", "reason").agg(F.sum("n").alias("n"))


class ParkedOrders:
    """Orders that name a user, restaurant or item that no dimension knows yet.

    A parked order has one row per key it lacks, in buckets of (kind, key). When
    dimension rows arrive, only the buckets of their keys are read. An order
    that has left is listed in `released`; its parked rows stay as they are. A
    key that is null itself can never arrive; its order stays parked.
    """

    _ORDER = "row_id string, object_id long, object_type string, sent_dttm string, payload string"
    _FIELDS = [f.split()[0] for f in _ORDER.split(", ")]

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.store = RunStore(spark, f"{root}/parked", f"kind string, key string, {self._ORDER}", ["kind", "key"], buckets)
        self.released = RunStore(spark, f"{root}/released", "row_id string", ["row_id"], buckets)

    @staticmethod
    def row_id() -> Column:
        """Name of an order message in the form of `as_message`."""
        return F.sha2(F.concat_ws("|", F.col("object_id").cast("string"), F.col("sent_dttm"), F.col("payload")), 256)

    def park(self, unknown: DataFrame, batch_id: int, source: str = "stream") -> bool:
        """`unknown`: enriched orders with `reasons`, as `split_known` returns them."""
        orders = unknown.withColumn("lacks", missing_keys(unknown)).withColumn("payload", as_message(unknown)).withColumn(
            "row_id", self.row_id())
        rows = orders.withColumn("lack", F.explode("lacks")).select("lack.kind", "lack.key", *self._FIELDS)
        return self.store.append(rows, batch_id, source)

    def waiting(self, keys: DataFrame) -> DataFrame:
        """Parsed orders, once each, that lack one of the (kind, key) and have not left; with their row_id."""
        keys = reliable(keys)
        hits = reliable(self.store.near(keys).join(keys, ["kind", "key"], "left_semi").select(*self._FIELDS).distinct())
        left = self.released.near(hits).select("row_id")
        return hits.join(left, "row_id", "left_anti").withColumn("payload", F.from_json("payload", schemas.ORDER_PAYLOAD))

    def parked(self) -> DataFrame:
        """All orders that wait: row_id, object_id, lacks (array of kind and key)."""
        lacks = self.store.read().groupBy("row_id", "object_id").agg(F.array_sort(F.collect_set(F.struct("kind", "key"))).alias("lacks"))
        return lacks.join(self.released.read().select("row_id"), "row_id", "left_anti")
