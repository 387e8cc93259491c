"""Vault of a group chat (hubs, links, satellites) and group conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martworks.functions.keys import hash_key
from martworks.functions.money import safe_ratio
from martworks.operators.joins import rows_present
from martworks.operators.ranking import top_k
from martworks.operators.vault import load_hub, load_link, load_satellite

SOURCE = "s3"
# table -> (key, business key, source table, business column, extra columns)
HUBS = {
    "h_users": ("hk_user_id", "user_id", "users", "id", ["registration_dt"]),
    "h_groups": ("hk_group_id", "group_id", "groups", "id", ["registration_dt"]),
    "h_dialogs": ("hk_message_id", "message_id", "dialogs", "message_id", ["message_ts"]),
}


def chat_hubs(stg: dict[str, DataFrame], dds: dict[str, DataFrame], load_dt: str) -> dict[str, DataFrame]:
    """New rows of the three hubs."""
    out = {}
    for table, (pk, name, source, column, extra) in HUBS.items():
        src = stg[source].select(F.col(column).alias(name), *extra)
        out[table] = load_hub(src, pk, name, dds.get(table), SOURCE, load_dt, extra)
    return out


def _member(df: DataFrame, column: str, hub: DataFrame, pk: str, name: str) -> DataFrame:
    """Adds a hub key by business key; rows the hub does not know drop out."""
    return df.join(hub.select(F.col(name).alias(column), pk), column)


def chat_links(stg: dict[str, DataFrame], hubs: dict[str, DataFrame], dds: dict[str, DataFrame], load_dt: str) -> dict[str, DataFrame]:
    """New rows of the four links; `hubs` holds the complete hubs."""
    users, groups = hubs["h_users"], hubs["h_groups"]
    admins = _member(_member(stg["groups"].select("id", "admin_id"), "admin_id", users, "hk_user_id", "user_id"),
                     "id", groups, "hk_group_id", "group_id")
    # the hub of messages is loaded from the same rows: its key is a hash, and no message can be missing there
    messages = stg["dialogs"].where("message_id is not null").select(
        hash_key(F.col("message_id")).alias("hk_message_id"), "message_from", "message_group")
    written = _member(messages, "message_from", users, "hk_user_id", "user_id")
    posted = _member(messages, "message_group", groups, "hk_group_id", "group_id")
    activity = _member(_member(stg["group_log"].select("user_id", "group_id").distinct(), "user_id", users, "hk_user_id", "user_id"),
                       "group_id", groups, "hk_group_id", "group_id")
    plan = {
        "l_admins": (admins, "hk_l_admin_id", ["hk_group_id", "hk_user_id"]),
        "l_user_message": (written, "hk_l_user_message", ["hk_user_id", "hk_message_id"]),
        "l_groups_dialogs": (posted, "hk_l_groups_dialogs", ["hk_message_id", "hk_group_id"]),
        "l_user_group_activity": (activity, "hk_l_user_group_activity", ["hk_user_id", "hk_group_id"]),
    }
    return {t: load_link(src, pk, members, dds.get(t), SOURCE, load_dt) for t, (src, pk, members) in plan.items()}


def chat_satellites(stg: dict[str, DataFrame], hubs: dict[str, DataFrame], links: dict[str, DataFrame],
                    dds: dict[str, DataFrame], load_dt: str) -> dict[str, DataFrame]:
    """Changed rows of the seven satellites."""
    # the hub key is a function of the business key, so no join to the hub is needed
    users = stg["users"].withColumn("hk_user_id", hash_key(F.col("id")))
    groups = stg["groups"].withColumn("hk_group_id", hash_key(F.col("id")))
    dialogs = stg["dialogs"].withColumn("hk_message_id", hash_key(F.col("message_id")))
    admins = links["l_admins"].join(hubs["h_groups"].select("hk_group_id", "registration_dt"), "hk_group_id").select(
        "hk_l_admin_id", F.lit(True).alias("is_admin"), F.col("registration_dt").alias("admin_from"))
    history = stg["group_log"].withColumn(
        "hk_l_user_group_activity", hash_key(hash_key(F.col("user_id")), hash_key(F.col("group_id"))))
    known = rows_present(history, links["l_user_group_activity"], "hk_l_user_group_activity")
    plan = {
        "s_admins": (admins, "hk_l_admin_id", ["is_admin", "admin_from"]),
        "s_user_chatinfo": (users, "hk_user_id", ["chat_name"]),
        "s_user_socdem": (users, "hk_user_id", ["country", "age"]),
        "s_group_private_status": (groups, "hk_group_id", ["is_private"]),
        "s_group_name": (groups, "hk_group_id", ["group_name"]),
        "s_dialog_info": (dialogs, "hk_message_id", ["message", "message_from", "message_to"]),
    }
    out = {t: load_satellite(src, key, attrs, dds.get(t), SOURCE, load_dt) for t, (src, key, attrs) in plan.items()}
    out["s_auth_history"] = auth_history(known, dds.get("s_auth_history"), load_dt)
    return out


def auth_history(log: DataFrame, existing: DataFrame | None, load_dt: str) -> DataFrame:
    """Membership events per activity link: a history, so every event is kept once."""
    from martworks.operators.filters import with_load_meta

    cols = ["hk_l_user_group_activity", "user_id_from", "event", "event_dt"]
    rows = log.select("hk_l_user_group_activity", "user_id_from", "event", F.col("datetime").alias("event_dt")).distinct()
    if existing is not None:
        old = existing.select(*cols).alias("old")
        same = [rows[c].eqNullSafe(F.col(f"old.{c}")) for c in cols[1:]]
        on = rows[cols[0]] == F.col(f"old.{cols[0]}")
        for condition in same:
            on = on & condition
        rows = rows.join(old, on, "left_anti")
    return with_load_meta(rows, SOURCE, load_dt)


def group_conversion(h_groups: DataFrame, l_groups_dialogs: DataFrame, l_user_message: DataFrame,
                     l_activity: DataFrame, s_auth_history: DataFrame, k: int = 10) -> DataFrame:
    """For the k oldest groups: added users, messages, writing users and their ratio."""
    oldest = top_k(h_groups.select("hk_group_id", "registration_dt", "group_id"), ["registration_dt", "group_id"], k)
    posts = rows_present(l_groups_dialogs.select("hk_group_id", "hk_message_id"), oldest, "hk_group_id")
    writers = posts.join(l_user_message.select("hk_message_id", "hk_user_id"), "hk_message_id", "left")
    talk = writers.groupBy("hk_group_id").agg(
        F.countDistinct("hk_message_id").alias("cnt_messages"), F.countDistinct("hk_user_id").alias("cnt_users"))
    added = rows_present(
        rows_present(l_activity.select("hk_l_user_group_activity", "hk_group_id", "hk_user_id"), oldest, "hk_group_id"),
        s_auth_history.where(F.col("event") == "add"), "hk_l_user_group_activity",
    ).groupBy("hk_group_id").agg(F.countDistinct("hk_user_id").alias("cnt_added_users"))
    return added.join(talk, "hk_group_id", "left").select(
        "hk_group_id", "cnt_added_users", "cnt_messages", "cnt_users",
        safe_ratio(F.col("cnt_users"), F.col("cnt_added_users"), "decimal(18,0)").cast("decimal(18,6)").alias("group_conversion"))
