"""Campaign messages joined with subscribers, delivered to three sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from martworks import schemas
from martworks.functions.time import now_epoch
from martworks.operators.filters import active_at
from martworks.operators.joins import join_static
from martworks.session import reliable
from martworks.sources.jdbc import append_jdbc
from martworks.sources.kafka import to_topic
from martworks.sources.ledger import BatchLedger, fenced
from martworks.sources.sinks import fan_out, write_snapshot
from martworks.sources.static import StaticSide
from martworks.streaming.letters import DeadLetters, read_messages
from martworks.streaming.sinks import start

# The fields of a campaign message.
FIELDS = [
    "restaurant_id", "adv_campaign_id", "adv_campaign_content", "adv_campaign_owner", "adv_campaign_owner_contact",
    "adv_campaign_datetime_start", "adv_campaign_datetime_end", "datetime_created",
]
OUT = [*FIELDS, "client_id", "trigger_datetime_created"]
SUBSCRIBER = ["client_id", "restaurant_id"]


def read_campaigns(df: DataFrame) -> DataFrame:
    """Every message with its `reason` (null for a usable one) and typed fields."""
    return read_messages(df, schemas.CAMPAIGN, "restaurant_id")


def parse_campaigns(df: DataFrame) -> DataFrame:
    """Typed fields of the usable messages."""
    return read_campaigns(df).where("reason is null").select(*FIELDS)


def active_campaigns(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Campaigns that run right now; in a stream, at the time of each micro-batch."""
    return active_at(df, "adv_campaign_datetime_start", "adv_campaign_datetime_end", now if now is not None else now_epoch())


def match_subscribers(campaigns: DataFrame, subscribers: DataFrame | StaticSide, now: Column | None = None) -> DataFrame:
    """One row per campaign and subscribed client, with the trigger time.

    A `StaticSide` is joined as it is; a plain table is freed of repeated rows first, in every call.
    """
    if isinstance(subscribers, StaticSide):
        matched = subscribers.join(campaigns)
    else:
        matched = join_static(campaigns, subscribers.select(*SUBSCRIBER), "restaurant_id", SUBSCRIBER)
    trigger = now if now is not None else now_epoch()
    return matched.select(*FIELDS, "client_id", trigger.cast("bigint").alias("trigger_datetime_created"))


def campaign_feedback(messages: DataFrame, subscribers: DataFrame | StaticSide, now: Column | None = None) -> DataFrame:
    return match_subscribers(active_campaigns(parse_campaigns(messages), now), subscribers, now)


def campaign_sinks(snapshot: str, jdbc: tuple[dict, str] | None = None, topic: tuple[str, dict] | None = None,
                   *more: Callable[[DataFrame, int], None], ledger: BatchLedger | None = None) -> Callable[[DataFrame, int], None]:
    """Snapshot, feedback table and topic from one cached micro-batch; with a ledger, table and topic take a batch once."""
    def outside(name: str, write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
        return fenced(ledger, name, write) if ledger else write

    sinks: list[Callable[[DataFrame, int], None]] = [lambda df, _: write_snapshot(df, snapshot)]
    if jdbc:
        sinks.append(outside("jdbc", lambda df, _: append_jdbc(df, *jdbc, null_columns=("feedback",))))
    if topic:
        sinks.append(outside("topic", lambda df, batch_id: to_topic(df, OUT, *topic, batch_id)))
    return fan_out(*sinks, *more)


def campaign_writer(subscribers: StaticSide, write: Callable[[DataFrame, int], None], dead: str,
                    now: Column | None = None) -> Callable[[DataFrame, int], None]:
    """`foreachBatch` function for messages with a `value`: malformed ones to the dead letters, feedback rows to `write`."""
    def run(df: DataFrame, batch_id: int) -> None:
        messages = reliable(read_campaigns(df.select("value")))
        DeadLetters(df.sparkSession, dead).keep(messages, batch_id)
        usable = messages.where("reason is null").select(*FIELDS)
        write(match_subscribers(active_campaigns(usable, now), subscribers, now), batch_id)
    return run


def run_campaigns(messages: DataFrame, subscribers: StaticSide, write: Callable[[DataFrame, int], None], checkpoint: str,
                  dead: str, now: Column | None = None, every: str | None = None) -> StreamingQuery:
    return start(messages, campaign_writer(subscribers, write, dead, now), checkpoint, every=every)
