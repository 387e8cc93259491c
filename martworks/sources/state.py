"""Load watermarks in a small append-only parquet table."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import SparkSession, functions as F

from martworks import schemas

class WatermarkStore:
    """get / save of a value per workflow key; the latest saved one counts.

    Save after the data is committed: a failure between the two repeats a batch,
    which the upsert writers make harmless.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def get(self, key: str, default=None):
        reader = self.spark.read.schema(schemas.WORKFLOW_STATE)
        try:
            row = (
                reader.parquet(self.path).where(F.col("workflow_key") == key)
                .agg(F.max_by("workflow_settings", "saved_at").alias("settings")).first()
            )
        except Exception as error:  # first run: no table yet
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return default
        return json.loads(row.settings)["last"] if row.settings else default

    def save(self, key: str, value) -> None:
        if isinstance(value, dt.datetime):
            value = value.isoformat(sep=" ")  # keeps microseconds
        settings = json.dumps({"last": value}, ensure_ascii=False, sort_keys=True)
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        self.spark.createDataFrame([(key, settings, now)], schemas.WORKFLOW_STATE).coalesce(1).write.mode("append").parquet(self.path)
