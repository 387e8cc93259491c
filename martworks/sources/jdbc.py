"""Relational databases through Spark's JDBC source. Drivers are not bundled;
connection options come from the caller."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F


def scan_options(conn: dict[str, str], table: str, split: tuple[str, object, object, int] | None = None) -> dict[str, str]:
    """Options of a table scan; `split` = (column, low, high, partitions) reads in parallel."""
    options = {**conn, "dbtable": table}
    if split:
        column, low, high, n = split
        options |= {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(n)}
    return options


def read_jdbc(spark: SparkSession, conn: dict[str, str], table: str,
              split: tuple[str, object, object, int] | None = None) -> DataFrame:
    return spark.read.format("jdbc").options(**scan_options(conn, table, split)).load()


def day_range(ts_col: str, day: str) -> str:
    """Half-open range text, usable with an index and pushed to the database."""
    start = dt.date.fromisoformat(day)
    stop = start + dt.timedelta(days=1)
    return f"{ts_col} >= timestamp '{start} 00:00:00' and {ts_col} < timestamp '{stop} 00:00:00'"


def read_jdbc_day(spark: SparkSession, conn: dict[str, str], table: str, ts_col: str, day: str,
                  split: tuple[str, object, object, int] | None = None) -> DataFrame:
    """One business date; the range predicate is pushed to the database."""
    return read_jdbc(spark, conn, table, split).where(day_range(ts_col, day))


def append_jdbc(df: DataFrame, conn: dict[str, str], table: str, null_columns: tuple[str, ...] = ()) -> None:
    """Append, with extra typed null text columns the table expects."""
    rows = df.withColumns({c: F.lit(None).cast("string") for c in null_columns})
    rows.write.format("jdbc").options(**scan_options(conn, table)).mode("append").save()


def once_statements(table: str, staging: str, ledger: str, sink: str, batch_id: int, columns: list[str]) -> list[str]:
    """Statements that move a staged batch to its table and enter it in the ledger, if the ledger lacks it.

    Run in one transaction, a batch is in the table exactly if it is in the
    ledger. The ledger has the columns sink and batch_id.
    """
    name = sink.replace("'", "''")
    new = f"not exists (select 1 from {ledger} where sink = '{name}' and batch_id >= {int(batch_id)})"
    names = ", ".join(columns)
    return [f"insert into {table} ({names}) select {names} from {staging} where {new}",
            f"insert into {ledger} (sink, batch_id) select '{name}', {int(batch_id)} where {new}"]


def append_once(df: DataFrame, conn: dict[str, str], table: str, ledger: str, sink: str, batch_id: int,
                execute: Callable[[list[str]], None], null_columns: tuple[str, ...] = ()) -> None:
    """Appends a micro-batch whose repetition adds nothing.

    Executors write the rows to a staging table of the batch, which a
    repetition overwrites; `execute` runs the statements that move them in one
    transaction of the database, with the caller's driver.
    """
    rows = df.withColumns({c: F.lit(None).cast("string") for c in null_columns})
    staging = f"{table}_batch_{int(batch_id)}"
    rows.write.format("jdbc").options(**scan_options(conn, staging)).mode("overwrite").save()
    execute([*once_statements(table, staging, ledger, sink, batch_id, rows.columns), f"drop table {staging}"])
