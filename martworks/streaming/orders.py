"""Order messages: raw store, dead letters, enrichment, parked orders, vault and the message for the counters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from martworks import schemas
from martworks.operators.filters import union_all
from martworks.operators.grouping import latest_per_key
from martworks.plans.order_vault import as_message, dimension_keys, enrich_orders, split_known, user_message
from martworks.session import reliable, staging
from martworks.sources.runs import BUCKETS, FAN, RunStore
from martworks.streaming.letters import DeadLetters, ParkedOrders, read_messages
from martworks.streaming.sinks import start, write_batch
from martworks.streaming.vault import OrderVault

Dimensions = tuple[DataFrame, DataFrame, DataFrame]


def _latest_message(rows: DataFrame) -> DataFrame:
    return latest_per_key(rows, ["object_id"], ["sent_dttm", "payload", "object_type"])


def raw_store(spark: SparkSession, root: str, buckets: int = BUCKETS, fan: int = FAN) -> RunStore:
    """The latest message of every object; one sent again replaces the older one."""
    return RunStore(spark, f"{root}/raw", "object_id long, object_type string, sent_dttm string, payload string", ["object_id"],
                    buckets, fan, _latest_message)


def _use(enriched: DataFrame, root: str, number: int, load_dt: str, source: str, out: int, buckets: int) -> None:
    """Of enriched orders the known ones go to the vault and the counters, the others are parked."""
    spark = enriched.sparkSession
    known, unknown = split_known(enriched)
    ParkedOrders(spark, root, buckets).park(unknown, number, source)
    OrderVault(spark, f"{root}/vault", buckets).load(known, number, load_dt, source)
    write_batch(user_message(known), f"{root}/messages", out)


def order_writer(root: str, users: DataFrame, restaurants: DataFrame, menu: DataFrame,
                 load_dt: Callable[[int], str], buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """`foreachBatch` function for messages with a `value`.

    Every message counts: it is malformed (dead letters), or stored raw and then known
    (vault, user messages) or parked until its user, restaurant and items
    arrive (`release_parked`). Equal messages of a batch are one. The table
    `batches` has the counts: n_in = n_malformed + n_repeated + n_known + n_parked.

    All stores take a batch once, so repeating it completes what a failure left
    out. What the vault says does not depend on how messages are dealt to batches or in
    which order they come. `buckets` is the number of key buckets of every store;
    whoever reads them gives the same.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        with staging(spark):
            with staging(spark) as keep:
                # the text is needed of dead letters only
                messages = reliable(read_messages(df.select("value"), schemas.ORDER_MESSAGE, "object_id").withColumn(
                    "value", F.when(F.col("reason").isNotNull(), F.col("value"))))
                DeadLetters(spark, f"{root}/dead", buckets).keep(messages, batch_id)
                orders = messages.where("reason is null").select("object_id", "object_type", "sent_dttm", "payload")
                raw_store(spark, root, buckets).append(
                    _latest_message(orders.withColumn("payload", F.to_json("payload"))), batch_id)
                n_read = keep(_read_counts(messages))
                enriched = keep(enrich_orders(orders, users, restaurants, menu, "sent_dttm"))
            _use(enriched, root, batch_id, load_dt(batch_id), "stream", batch_id, buckets)
            write_batch(_batch_counts(n_read, enriched), f"{root}/batches", batch_id)
    return write


def _read_counts(messages: DataFrame) -> DataFrame:
    return messages.agg(F.count("*").alias("n_in"), F.count_if(F.col("reason").isNotNull()).alias("n_malformed"))


def _batch_counts(read: DataFrame, enriched: DataFrame) -> DataFrame:
    known, zero = F.size("reasons") == 0, F.lit(0).cast("long")
    used = enriched.agg(F.count_if(known).alias("n_known"), F.count_if(~known).alias("n_parked")).select(
        zero.alias("n_in"), zero.alias("n_malformed"), "n_known", "n_parked")
    names = ["n_in", "n_malformed", "n_known", "n_parked"]
    read = read.select("n_in", "n_malformed", zero.alias("n_known"), zero.alias("n_parked"))
    total = union_all([read, used]).agg(*[F.sum(n).alias(n) for n in names])
    return total.withColumn("n_repeated", F.col("n_in") - F.col("n_malformed") - F.col("n_known") - F.col("n_parked"))


def release_parked(root: str, arrived: Dimensions, dimensions: Dimensions, number: int, load_dt: str,
                   buckets: int = BUCKETS) -> DataFrame:
    """Uses the parked orders that waited for rows of `arrived`, new rows of the dimensions; returns what became of them.

    Only the buckets of the new keys are read, and only their orders enriched,
    with the whole dimensions. An order that still lacks something stays
    parked; one that leaves does so once. `number` counts the releases from 0; a
    release that is repeated adds nothing.
    """
    spark = dimensions[0].sparkSession
    parking = ParkedOrders(spark, root, buckets)
    again = parking.released.holds(number, "release")
    with staging(spark) as keep:
        orders = reliable(parking.waiting(dimension_keys(*arrived)).where(F.lit(not again)).drop("row_id"))
        if again:
            return keep(orders.select("object_id", "sent_dttm", F.lit(True).alias("released")))
        # user messages of releases stand beside those of the batches, under negative numbers
        with staging(spark) as keep_inside:
            enriched = keep_inside(enrich_orders(orders, *dimensions, "sent_dttm"))
        _use(enriched, root, number, load_dt, "release", -1 - number, buckets)
        known = split_known(enriched)[0]
        parking.released.append(known.select("object_id", "sent_dttm", as_message(known).alias("payload")).select(
            parking.row_id().alias("row_id")).distinct(), number, "release")
        return keep(enriched.select("object_id", "sent_dttm", (F.size("reasons") == 0).alias("released")))


def run_orders(messages: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
               every: str | None = None) -> StreamingQuery:
    """Order stream over messages with a `value`; those sent again add nothing to the stores, and late ones count."""
    return start(messages, write, checkpoint, every=every)
