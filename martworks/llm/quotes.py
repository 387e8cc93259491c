"""Quotation linking: quoted passages are hashed and joined to the messages they come from.

Message texts use mail quoting: a line that starts with n marks (`>`, spaces
between and after them allowed) is quoted at level n. Consecutive lines of one
level up to a blank line form a passage. Own passages (level 0) of all messages are reduced to one
origin per hash, the earliest message that wrote it, before anything is joined:
the join is many-to-one, however common a passage is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from martworks.llm.common import staged, text_or_empty
from martworks.operators.ranking import dense_ids

MARKS = r"^(?:\s*>)+"
_AT = ["thread", "place"]


def quote_level(line: Column) -> Column:
    return F.length(F.translate(F.regexp_substr(line, F.lit(MARKS)), " \t", ""))


def normalised(line: Column) -> Column:
    """Lower case, single spaces, no quote marks."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(line, MARKS, "")), r"\s+", " "))


def passages(messages: DataFrame) -> DataFrame:
    """(thread, place, no, level, lines, hash) per passage, which is a paragraph of one level.

    A blank line ends a passage and belongs to it. Levels of the lines are folded
    over the message's own array, so no row leaves its task; a message's passages
    are as long as the message.
    """
    line = F.split(text_or_empty(), "\r?\n")
    line = F.transform(line, lambda x: F.struct(
        x.alias("line"), F.coalesce(quote_level(x), F.lit(0)).alias("level"), (normalised(x) == "").alias("blank")))
    start = F.struct(F.array().cast("array<struct<level:int,lines:array<string>>>").alias("done"),
                     F.lit(-1).alias("level"), F.array().cast("array<string>").alias("lines"), F.lit(False).alias("blank"))

    def closed(s: Column) -> Column:
        return F.when(s["level"] >= 0, F.concat(s["done"], F.array(F.struct(
            s["level"].alias("level"), s["lines"].alias("lines"))))).otherwise(s["done"])

    def step(s: Column, x: Column) -> Column:
        more = (x["level"] == s["level"]) & ~s["blank"]
        gap = x["blank"] & (s["level"] >= 0) & ((x["level"] == 0) | (x["level"] == s["level"]))
        return F.when(more | gap, F.struct(s["done"].alias("done"), s["level"].alias("level"), F.concat(
            s["lines"], F.array(x["line"])).alias("lines"), x["blank"].alias("blank"))).otherwise(F.struct(
                closed(s).alias("done"), x["level"].alias("level"), F.array(x["line"]).alias("lines"), x["blank"].alias("blank")))

    parts = messages.select(*_AT, F.posexplode(F.aggregate(line, start, step, closed)).alias("no", "part"))
    body = F.array_join(F.filter(F.transform("part.lines", normalised), lambda x: x != ""), "\n")
    return parts.select(*_AT, "no", F.col("part.level").alias("level"), F.col("part.lines").alias("lines"),
                        F.when(body != "", F.sha2(body, 256)).alias("hash"))


def link_quotations(messages: DataFrame) -> DataFrame:
    """One row per message: thread, place, role, text (quotes cut out), reply_thread, reply_place, n_quoted, n_linked,
    levels, root_thread, root_place, reply_order.

    `messages` has thread, place (order in the thread), role and text. A quoted
    passage of any level is looked up among the own passages of its thread, then
    of all messages; its origin is the earliest message, by (place, thread), that
    wrote it, and counts if it comes before the quoting one in that order.
    n_quoted and n_linked count passages of all levels, `levels` tells them by
    level as (level, n_quoted, n_linked). Of the origins of the lowest level that
    has any, the one with most linked lines is replied to, then the last. The root
    is the message at the top of the chain of replies, a message without reply
    its own; reply_order numbers all messages root by root, in each by (place, thread),
    from a range-partitioned sort. Null texts are
    empty; messages with a null thread or place are returned without links;
    repeated rows are merged into one; other columns are ignored.
    """
    plain = messages.select("thread", "place", "role", "text").groupBy(*_AT).agg(
        F.min_by("role", F.struct("text", "role")).alias("role"), F.min("text").alias("text"))
    parts = staged(passages(plain))
    here = F.struct("place", "thread")
    origins = parts.where("level = 0 and hash is not null and thread is not null and place is not null").groupBy("hash").agg(
        F.min(here).alias("origin"))
    at_home = parts.where("level = 0 and hash is not null").groupBy("thread", "hash").agg(F.min("place").alias("home"))
    quoted = parts.where("level > 0 and hash is not null").join(origins, "hash", "left").join(
        at_home, ["thread", "hash"], "left").withColumn(
        "origin", F.when(F.col("home") < F.col("place"), F.struct(F.col("home").alias("place"), "thread"))
        .when(F.col("origin") < here, F.col("origin")))
    linked_n = F.when(F.col("origin").isNotNull(), F.col("n")).otherwise(F.lit(0))
    by_level = quoted.groupBy(*_AT, "level", "origin").agg(
        F.sum(F.size("lines")).alias("lines"), F.count("*").alias("n")).groupBy(*_AT, "level").agg(
        F.sum("n").alias("n_quoted"), F.sum(linked_n).alias("n_linked"),
        F.max(F.when(F.col("origin").isNotNull(), F.struct("lines", "origin")))["origin"].alias("origin"))
    # one entry per level of a message
    replies = by_level.groupBy(*_AT).agg(
        F.sum("n_quoted").alias("n_quoted"), F.sum("n_linked").alias("n_linked"),
        F.min(F.when(F.col("origin").isNotNull(), F.struct("level", "origin")))["origin"].alias("origin"),
        F.array_sort(F.collect_list(F.struct("level", "n_quoted", "n_linked"))).alias("levels"))
    own = parts.where("level = 0").groupBy(*_AT).agg(F.array_join(F.transform(F.array_sort(F.collect_list(
        F.struct("no", "lines"))), lambda p: F.array_join(p["lines"], "\n")), "\n").alias("own"))
    linked = staged(plain.join(replies, _AT, "left").join(own, _AT, "left").select(
        *_AT, "role", F.coalesce("own", F.lit("")).alias("text"), F.col("origin.thread").alias("reply_thread"),
        F.col("origin.place").alias("reply_place"), F.coalesce("n_quoted", F.lit(0)).alias("n_quoted"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"), F.coalesce("levels", F.array().cast(
            "array<struct<level:int,n_quoted:bigint,n_linked:bigint>>")).alias("levels")))
    roots = _roots(linked).select("node.thread", "node.place", "root")
    rooted = linked.join(roots, _AT, "left").withColumn("root", F.coalesce("root", F.struct("thread", "place")))
    return dense_ids(
        rooted.select(*linked.columns, F.col("root.thread").alias("root_thread"), F.col("root.place").alias("root_place")),
        ["root_thread", "root_place", "place", "thread"], "reply_order")


def _roots(linked: DataFrame) -> DataFrame:
    """(node, root): the top of each reply's chain. A message replies to one earlier message, so the chains are
    followed by doubling: every round joins the messages that are not at the top yet with the message they have reached so far."""
    reached = staged(linked.where("reply_place is not null").select(
        F.struct("thread", "place").alias("node"), F.struct(F.col("reply_thread").alias("thread"), F.col("reply_place").alias("place")).alias("root")))
    done, active = None, reached
    while True:
        above = reached.select(F.col("node").alias("root"), F.col("root").alias("next"))
        moved = staged(active.join(above, "root", "left").select(
            "node", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        ended = moved.where("not moved").select("node", "root")
        done = ended if done is None else done.unionByName(ended)
        active = moved.where("moved").select("node", "root")
        if not active.head(1):
            return done
        reached = done.unionByName(active)


def as_mail(conversations: DataFrame) -> DataFrame:
    """Conversations as mail: each turn quotes the turn before it at level 1 and the one before that at level 2.

    Rows that share conversation and turn are merged into the one with the smallest text.
    """
    turns = conversations.groupBy("conv_id", "turn").agg(
        F.min_by("role", F.struct("text", "role")).alias("role"), F.min("text").alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn")

    def quoted(text: Column, mark: str) -> Column:
        return F.concat(F.regexp_replace(text, "(?m)^", mark), F.lit("\n"))

    return turns.withColumn("before", F.lag("text", 1).over(order)).withColumn("earlier", F.lag("text", 2).over(order)).select(
        F.col("conv_id").alias("thread"), F.col("turn").alias("place"), "role", F.concat(
            F.coalesce(quoted(F.col("earlier"), "> > "), F.lit("")), F.coalesce(quoted(F.col("before"), "> "), F.lit("")),
            text_or_empty()).alias("text"))
