"""The prefix trie against a brute-force one."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from martworks.llm.common import ready
from martworks.llm.trie import SpillingQueue, rebuilt_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    conversations = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            conversations[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    for turns in conversations.values():
        turns.sort()
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for conv, own in conversations.items():
        h = zlib.crc32(str(conv).encode()) % 6
        turns = tuple((role, text) for _, role, text in conversations.get(conv - conv % 100, [])[:h] + own[h:])
        for depth in range(len(turns) + 1):
            members[turns[:depth]].append(conv)
        ends[turns].append(conv)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
        saved[node] = sum(saved[c] for c in children[node]) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else -1, len(m), len(children[n]), leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, m in members.items())


def made(seed=1):
    rnd = random.Random(seed)
    rows = []
    for conv in [*range(-5, 30), *range(95, 120), 300, 301, 399]:
        for turn in range(rnd.randint(0, 9)):
            rows.append((conv, rnd.choice([None, turn, turn]), rnd.choice(["u", "a", None]), rnd.choice(["x", "yy", None, "é\U0001F600"])))
    copies = [(conv, turn, "u", "same" * turn) for conv in range(200, 240) for turn in range(8)]
    return [*rows, (None, 1, "u", "x"), *copies]


@pytest.mark.parametrize("members,queue_rows", [(None, 1000), (2, 1), (5, 3)])
def test_trie_is_the_brute_force_one(spark, members, queue_rows):
    rows = made()
    df = ready(spark).createDataFrame(rows, SCHEMA)
    got = rebuilt_trie(df, members=members, queue_rows=queue_rows)
    assert sorted(tuple(-1 if v is None else v for v in r) for r in got.collect()) == brute(rows)


def test_clashing_columns_ties_and_repeats(spark):
    rows = [(1, 0, "u", "x"), (1, 0, "u", "x"), (2, None, None, None), (2, 0, "u", "x" * 100_000)]
    df = ready(spark).createDataFrame([(*r, 9, 9, "z") for r in rows], SCHEMA + ", depth int, k1 int, shard string")
    assert sorted(tuple(-1 if v is None else v for v in r) for r in rebuilt_trie(df).collect()) == brute(rows)


def test_empty_table(spark):
    assert rebuilt_trie(ready(spark).createDataFrame([], SCHEMA)).count() == 0


def test_queue_spills_and_sums():
    queue, want = SpillingQueue(limit=3), defaultdict(lambda: [0, 0, 0])
    rnd = random.Random(5)
    for i in range(200):
        to, sums = (-rnd.randint(0, 5), rnd.randint(0, 3), 0), (1, i, rnd.randint(0, 9))
        queue.push(to, sums)
        want[to] = [x + y for x, y in zip(want[to], sums)]
    assert queue.runs
    assert [queue.take(to) for to in sorted(want)] == [tuple(want[to]) for to in sorted(want)]
    assert queue.take((1, 0, 0)) == (0, 0, 0)
