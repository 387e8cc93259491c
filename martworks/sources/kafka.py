"""Topics through Spark's Kafka source and sink. The connector package is not
bundled; brokers and security come from the caller."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martworks.functions.text import json_message, kafka_text


def topic_options(brokers: str, security: dict[str, str] | None = None, **extra: str) -> dict[str, str]:
    """Connector options; security keys get their `kafka.` prefix."""
    options = {"kafka.bootstrap.servers": brokers}
    options |= {f"kafka.{k}": v for k, v in (security or {}).items()}
    return options | extra


def read_topic(spark: SparkSession, topic: str, options: dict[str, str], max_per_trigger: int | None = None) -> DataFrame:
    """Stream of a topic from the earliest offset, key and value as strings."""
    reader = spark.readStream.format("kafka").options(**options).option("subscribe", topic)
    reader = reader.option("startingOffsets", options.get("startingOffsets", "earliest"))
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return kafka_text(reader.load())


def topic_value(df: DataFrame, columns: list[str | Column]) -> DataFrame:
    """The rows with their JSON message as `value`."""
    return df.withColumn("value", json_message(*columns))


def topic_rows(df: DataFrame, columns: list[str | Column], batch_id: int | None = None) -> DataFrame:
    """What is written to a topic: `value`, and the number of the batch as a header, by which readers drop repeated batches."""
    rows = topic_value(df, columns)
    if batch_id is None:
        return rows.select("value")
    header = F.struct(F.lit("batch_id").alias("key"), F.lit(str(int(batch_id))).cast("binary").alias("value"))
    return rows.select("value", F.array(header).alias("headers"))


def to_topic(df: DataFrame, columns: list[str | Column], topic: str, options: dict[str, str], batch_id: int | None = None) -> None:
    """Write a batch to a topic."""
    topic_rows(df, columns, batch_id).write.format("kafka").options(**options).option("topic", topic).save()
