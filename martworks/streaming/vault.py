"""The order vault as three growing tables: hubs, links, and the histories of the satellites."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from martworks.plans.order_vault import vault_rows, vault_table
from martworks.session import reliable, staging
from martworks.sources.history import HistoryStore
from martworks.sources.runs import BUCKETS, FAN, RunStore

VAULT_TABLES = [
    "h_order", "h_user", "h_restaurant", "h_product", "h_category",
    "l_order_product", "l_product_category", "l_order_user", "l_product_restaurant",
    "s_order_cost", "s_order_status", "s_product_names", "s_restaurant_names", "s_user_names",
]
_META = "load_dt timestamp_ntz, load_src string"


class OrderVault:
    """5 hubs, 4 links and 5 satellites; a load reads the key buckets that its rows touch, and no others."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS, fan: int = FAN):
        table = ("tbl",)
        self.hubs = RunStore(spark, f"{root}/hubs", f"tbl string, pk string, business_key string, order_dt timestamp_ntz, {_META}",
                             ["tbl", "pk"], buckets, fan, parts=table)
        self.links = RunStore(spark, f"{root}/links", f"tbl string, pk string, a string, b string, {_META}", ["tbl", "pk"], buckets, fan, parts=table)
        self.satellites = HistoryStore(spark, f"{root}/satellites", ["tbl", "pk"], "tbl string, pk string, a0 string, a1 string",
                                       "hashdiff", buckets, fan, table)

    @staticmethod
    def _add_new(store: RunStore, rows: DataFrame, batch_id: int, source: str) -> None:
        if store.holds(batch_id, source):
            return
        if not store.manifest().runs:
            store.append(rows, batch_id, source)
            return
        with staging(store.spark):
            rows = reliable(rows)
            known = store.near(rows).select("tbl", "pk")
            store.append(rows.join(known, ["tbl", "pk"], "left_anti"), batch_id, source)

    def load(self, orders: DataFrame, batch_id: int, load_dt: str, source: str = "stream") -> None:
        """Known orders of a batch. Repeating a batch, whole or after a failure half way, adds what is not there yet."""
        hubs, links, versions = vault_rows(orders, load_dt, "sent_dttm")
        self._add_new(self.hubs, hubs, batch_id, source)
        self._add_new(self.links, links, batch_id, source)
        self.satellites.load(versions, batch_id, source, unique=True)

    def table(self, name: str) -> DataFrame:
        """A table of the vault with its own column names; of a satellite the versions that are changes."""
        rows = {"h": self.hubs.read, "l": self.links.read, "s": self.satellites.changes}[name[0]]()
        return vault_table(rows, name)

    def all_rows(self) -> DataFrame:
        """(tbl, rows): how much every table holds."""
        parts = [df.select("tbl") for df in (self.hubs.read(), self.links.read(), self.satellites.changes())]
        return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("tbl").agg(F.count("*").alias("rows"))
