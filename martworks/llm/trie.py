"""Prefix trie of conversations: what they share, and totals of every subtree.

A node is a sequence of first turns. Its name is the depth with the sums of
hashes of (depth, role, text) over these turns, so names follow from running
sums and nodes, members and parents from plain aggregates, however long or
common a conversation is. Subtree totals travel by time-forward processing:
nodes are sorted by reverse level order, each takes the messages addressed to
it from a priority queue and sends its total on to its parent. Subtrees with
few members are shards worked on side by side; their roots then send to the
nodes above.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from martworks.llm.common import fold, staged, text_or_empty
from martworks.llm.scan import running
from martworks.session import work_partitions

KEY = ["depth", "k1", "k2"]
# halves of a name are sums of 60-bit hashes modulo this
_MOD = 1 << 60
# messages a queue holds in memory; ids in one piece of a list of members
QUEUE_ROWS, PIECE_IDS = 200_000, 8192


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, role, text): turns in order from 1; null turns first, ties by role and text, nulls empty.

    Rows without conv_id belong to no conversation and are left out; repeated rows stay.
    """
    plain = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", text_or_empty("role").alias("role"), text_or_empty().alias("text"))
    return running(plain, "conv_id", [F.col("turn").asc_nulls_first(), "role", "text"], {"place": F.lit(1).cast("long")}).drop("turn")


def rebuilt(turns: DataFrame, block: int = 100, heads: int = 6) -> DataFrame:
    """(conv_id, depth, role, text): conversations that begin as the first one of their block does.

    Conversation c begins with the first h turns of the conversation
    c - c mod block, as far as there are so many, and goes on with its own
    after the first h; h is crc32(c as text) mod `heads`. The remainder is
    never negative, also of negative ids.
    """
    own = staged(turns)
    h, base = fold("conv_id", heads), F.col("conv_id") - F.pmod("conv_id", F.lit(block))
    first = own.where(F.col("place") < heads).select(F.col("conv_id").alias("base"), "place", "role", "text")
    have = first.groupBy("base").agg(F.max("place").alias("have"))
    ids = own.groupBy("conv_id").agg(F.count("*").alias("n")).select("conv_id", base.alias("base"), h.alias("h"))
    begun = ids.join(first, "base").where("place <= h").select("conv_id", F.col("place").alias("depth"), "role", "text")
    rest = own.withColumn("h", h).where("place > h").withColumn("base", base).join(have, "base", "left")
    return begun.unionByName(rest.select(
        "conv_id", (F.least("h", F.coalesce("have", F.lit(0))) + F.col("place") - F.col("h")).alias("depth"), "role", "text"))


class SpillingQueue:
    """Messages in the order of their addresses; beyond a number they wait in sorted files.

    Addresses are triples of integers, messages triples of sums. What is
    written is summed up per address before.
    """

    _ROW = struct.Struct("<6q")

    def __init__(self, limit: int = QUEUE_ROWS):
        self.limit, self.heap, self.runs, self.fronts = limit, [], [], []

    def push(self, to: tuple, sums: tuple) -> None:
        heapq.heappush(self.heap, (to, sums))
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        out = tempfile.TemporaryFile()
        at, total = None, (0, 0, 0)
        for to, sums in sorted(self.heap):
            if to != at and at is not None:
                out.write(self._ROW.pack(*at, *total))
                total = (0, 0, 0)
            at, total = to, tuple(map(sum, zip(total, sums)))
        out.write(self._ROW.pack(*at, *total))
        out.seek(0)
        self.heap = []
        self.runs.append(self._read(out))
        self._next(len(self.runs) - 1)

    def _read(self, out) -> Iterator[tuple]:
        while block := out.read(self._ROW.size * 4096):
            for row in self._ROW.iter_unpack(block):
                yield row[:3], row[3:]
        out.close()

    def _next(self, run: int) -> None:
        row = next(self.runs[run], None)
        if row is not None:
            heapq.heappush(self.fronts, (*row, run))

    def take(self, at: tuple) -> tuple:
        """Sums of all messages to this address; addresses are asked for in ascending order."""
        a = b = c = 0
        while self.heap and self.heap[0][0] == at:
            x, y, z = heapq.heappop(self.heap)[1]
            a, b, c = a + x, b + y, c + z
        while self.fronts and self.fronts[0][0] == at:
            _, (x, y, z), run = heapq.heappop(self.fronts)
            a, b, c = a + x, b + y, c + z
            self._next(run)
        return a, b, c


_NODE = ["shard", *KEY, "p1", "p2", "top", "own", "children", "leaves", "saved"]


def _time_forward(limit: int):
    """Totals of the nodes (columns _NODE), which come sorted by shard, then deepest first, then by name.

    children, leaves, saved: what arrived from outside the shard; own: the node's own share of saved.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queue = SpillingQueue(limit)
        for frame in frames:
            n, done = len(frame), []
            for _, depth, k1, k2, p1, p2, top, own, children, leaves, saved in zip(*(frame[c].tolist() for c in _NODE)):
                x, y, z = queue.take((-depth, k1, k2))
                children, leaves, saved = children + x, leaves + y, saved + z + own
                leaves = leaves if children else 1
                if not top:
                    queue.push((1 - depth, p1, p2), (1, leaves, saved))
                done.append((children, leaves, saved))
            out = np.array(done, np.int64).reshape(n, 3)
            yield frame[[*KEY, "p1", "p2", "top"]].assign(n_children=out[:, 0], n_leaves=out[:, 1], saved_tokens=out[:, 2])

    return run


_DONE = "depth long, k1 long, k2 long, p1 long, p2 long, top boolean, n_children long, n_leaves long, saved_tokens long"


def _member_lists(ends: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256): hash of the ids in ascending order, joined by commas.

    Ids are sorted in ranges over all tasks, which join them into pieces; a
    node's pieces are hashed one after the other, so no list is ever held whole.
    """
    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            names = frame[KEY].to_numpy()
            new = np.append(True, (names[1:] != names[:-1]).any(axis=1)) if len(frame) else np.zeros(0, bool)
            new[::PIECE_IDS] = True
            at = np.append(np.flatnonzero(new), len(frame))
            ids = frame["conv_id"].tolist()
            out = frame.iloc[at[:-1]][KEY]
            yield out.assign(first=[ids[a] for a in at[:-1]], body=[",".join(map(str, ids[a:b])) for a, b in zip(at[:-1], at[1:])])

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state = None, None
        for frame in frames:
            done = []
            for *name, body in zip(*(frame[c].tolist() for c in [*KEY, "body"])):
                if name == at:
                    state.update(b"," + body.encode())
                else:
                    if at:
                        done.append((*at, state.hexdigest()))
                    at, state = name, hashlib.sha256(body.encode())
            yield pd.DataFrame(done, columns=[*KEY, "ends_sha256"])
        if at:
            yield pd.DataFrame([(*at, state.hexdigest())], columns=[*KEY, "ends_sha256"])

    n = work_partitions(ends.sparkSession)
    order = [*KEY, "conv_id"]
    joined = ends.select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order).mapInPandas(
        pieces, "depth long, k1 long, k2 long, first long, body string")
    return joined.repartition(n, *KEY).sortWithinPartitions(*KEY, "first").mapInPandas(
        hashed, "depth long, k1 long, k2 long, ends_sha256 string")


def _half(at: int) -> Column:
    """60 bits of the hash of a turn at its depth; lengths keep role and text apart."""
    whole = F.sha2(F.concat_ws(":", F.col("depth").cast("string"), F.octet_length("role").cast("string"), F.concat("role", "text")), 256)
    return F.conv(F.substring(whole, at, 15), 16, 10).cast("decimal(38,0)")


def prefix_trie(ids: DataFrame, turns: DataFrame, members: int | None = None, queue_rows: int = QUEUE_ROWS) -> DataFrame:
    """One row per node of the trie: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    `ids` has conv_id, every conversation once; `turns` has conv_id, depth
    (1, 2, … without gaps), role and text, none of them null. saved_tokens sums
    (n_convs - 1) times the code points of the last text over the subtree;
    ends_sha256 is the hash of the members that end at the node. The root has
    depth 0 and no parent, and also holds conversations without turns. Without
    conversations there is no root and no row.

    A node with one member has one leaf and saves nothing; those with more take
    part in the passing of messages. Shards are the largest subtrees of at most `members`
    conversations (by default 1000, or a 100,000th of all); above them one
    sorted stream holds the few nodes with more members. A queue spills
    beyond `queue_rows` messages.
    """
    spark = ids.sparkSession
    ids = staged(ids.select("conv_id"))
    whole = ids.agg(F.count("*").alias("n"), F.min("conv_id").alias("least")).first()
    most = members or max(1000, whole.n // 100_000)
    sized = turns.select("conv_id", "depth", F.char_length("text").cast("long").alias("length"), _half(1).alias("v1"), _half(17).alias("v2"))
    summed = running(sized, "conv_id", [F.col("depth")], {"s1": F.col("v1"), "s2": F.col("v2")})
    mod = F.lit(_MOD).cast("decimal(38,0)")
    rows = staged(summed.select("conv_id", "depth", "length", *[
        (value % mod).cast("long").alias(name) for name, value in (
            ("k1", F.col("s1")), ("k2", F.col("s2")), ("p1", F.col("s1") - F.col("v1")), ("p2", F.col("s2") - F.col("v2")))]))
    last = rows.groupBy("conv_id").agg(F.max(F.struct(*KEY)).alias("last")).select("conv_id", "last.*")
    zero = F.lit(0).cast("long")
    ends = staged(ids.join(last, "conv_id", "left").select("conv_id", *[F.coalesce(c, zero).alias(c) for c in KEY]))
    nodes = staged(rows.groupBy(*KEY).agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("length").alias("length"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2")))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                         F.col("conv_id").alias("parent_conv_id"), F.col("n_convs").alias("parent_n"))
    least, n = F.lit(whole.least).cast("long"), F.lit(whole.n).cast("long")
    tops = nodes.where("depth = 1").withColumn("parent_conv_id", least).withColumn("parent_n", n)
    lower = nodes.where("depth > 1").join(above, ["depth", "p1", "p2"]).select(*tops.columns)
    ended = ends.groupBy(*KEY).agg(F.count("*").alias("n_ends"))
    root = ids.limit(1).select(
        *[zero.alias(c) for c in KEY], n.alias("n_convs"), least.alias("conv_id"), zero.alias("length"), zero.alias("p1"), zero.alias("p2"),
        F.lit(None).cast("long").alias("parent_conv_id"), F.lit(None).cast("long").alias("parent_n"))
    tree = staged(tops.unionByName(lower).unionByName(root).join(ended, KEY, "left").withColumn(
        "n_ends", F.coalesce("n_ends", zero)))

    own = (F.col("n_convs") - 1) * F.col("length")
    up = {"p1": "k1", "p2": "k2"}

    def to_parents(sent: DataFrame, **sums: Column) -> DataFrame:
        return sent.select((F.col("depth") - 1).alias("depth"), *[F.col(p).alias(k) for p, k in up.items()], *[
            v.cast("long").alias(name) for name, v in sums.items()]).groupBy(*KEY).agg(*[F.sum(s).alias(s) for s in sums])

    # single members below a shared node (or the root): one child and one leaf each
    single = to_parents(tree.where("n_convs = 1 and (parent_n > 1 or depth = 1)"), children=F.lit(1), leaves=F.lit(1))
    shared = staged(tree.where("n_convs > 1 or depth = 0").join(single, KEY, "left").select(
        *tree.columns, own.alias("own"), F.coalesce("children", zero).alias("children"), F.coalesce("leaves", zero).alias("leaves")))
    small = (F.col("n_convs") <= most) & (F.col("depth") > 0)
    top = (F.col("depth") == 1) | (F.col("parent_n") > most)
    shard = F.struct(*KEY)
    # the shard of a node stands on the path of its smallest member
    heads = shared.where(small & top).select(*KEY)
    owners = rows.join(heads, KEY).select("conv_id", shard.alias("shard"))
    within = shared.where(small).join(owners, "conv_id").select(
        F.xxhash64("shard").alias("shard"), *KEY, "p1", "p2", top.alias("top"), "own", "children", "leaves", zero.alias("saved"))
    parts = work_partitions(spark)
    order = ["shard", F.col("depth").desc(), "k1", "k2"]
    light = staged(within.repartition(parts, "shard").sortWithinPartitions(*order).mapInPandas(_time_forward(queue_rows), _DONE))
    sent = to_parents(light.where("top"), children_=F.lit(1), leaves_=F.col("n_leaves"), saved_=F.col("saved_tokens"))
    upper = shared.where(~small).join(sent, KEY, "left").select(
        zero.alias("shard"), *KEY, "p1", "p2", (F.col("depth") == 0).alias("top"), "own",
        *[(F.col(c) + F.coalesce(f"{c}_", zero)).alias(c) for c in ("children", "leaves")], F.coalesce("saved_", zero).alias("saved"))
    heavy = upper.repartition(1).sortWithinPartitions(*order).mapInPandas(_time_forward(queue_rows), _DONE)
    totals = light.unionByName(heavy).drop("p1", "p2", "top")
    empty = hashlib.sha256(b"").hexdigest()
    return tree.join(totals, KEY, "left").join(_member_lists(ends), KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs",
        F.coalesce("n_children", (F.col("n_ends") == 0).cast("long")).alias("n_children"),
        F.coalesce("n_leaves", F.lit(1).cast("long")).alias("n_leaves"), F.coalesce("saved_tokens", zero).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"))


def rebuilt_trie(conversations: DataFrame, **how) -> DataFrame:
    """`prefix_trie` of the rebuilt conversations; conversations left without turns are members of the root.

    Null roles and texts are empty, null turns first; rows without conv_id are left out;
    repeated rows are turns of their own; an empty table gives no rows; other columns are ignored.
    """
    turns = staged(numbered(conversations))
    return prefix_trie(turns.select("conv_id").distinct(), rebuilt(turns), **how)
