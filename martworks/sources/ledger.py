"""Which batches an outside sink has taken, so that a repeated micro-batch adds nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martworks.sources.state import WatermarkStore


class BatchLedger:
    """The last batch of every sink, in the shared folder.

    A batch is entered after its rows are out. A job that fails between the two
    sends that one batch again; sinks that must not see it twice keep a
    ledger of their own beside the rows (`jdbc.append_once`) or mark the rows with
    their batch (`kafka.to_topic`).
    """

    def __init__(self, spark: SparkSession, path: str):
        self.state = WatermarkStore(spark, path)

    def last(self, sink: str) -> int:
        return self.state.get(sink, -1)

    def once(self, sink: str, batch_id: int, write: Callable[[], None]) -> bool:
        """Runs `write` unless the sink has this batch or a later one."""
        if batch_id <= self.last(sink):
            return False
        write()
        self.state.save(sink, batch_id)
        return True


def fenced(ledger: BatchLedger, sink: str, write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A sink of `fan_out` that takes every batch once."""
    return lambda df, batch_id: ledger.once(sink, batch_id, lambda: write(df, batch_id)) and None
