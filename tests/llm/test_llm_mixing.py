"""Systematic sampling: targets, copies and the mix itself."""

from __future__ import annotations

from collections import Counter

import pytest

from martworks.llm.common import ready
from martworks.llm.mixing import mix, mixed

SCHEMA = "doc_id long, source string, text string"


def targets(sizes: dict) -> dict:
    """Targets by sharing out the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    fixed: dict = {}
    while True:
        left = 1.5 * sum(sizes.values()) - sum(fixed.values())
        free = [s for s in order if s not in fixed]
        goal = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if goal[s] > 2 * sizes[s]]
        if not above:
            return {**goal, **fixed}
        fixed.update({s: 2.0 * sizes[s] for s in above})


def made():
    out, no = [], 0
    for source, docs, words in (("a", 400, 3), ("b", 30, 50), (None, 60, 7), ("", 5, 1), ("ü", 900, 4), ("zz", 300, 20)):
        for i in range(docs):
            out.append((no, source, " ".join(["w"] * (1 + (i * 7 + words) % (2 * words)))))
            no += 1
    return [*out, (None, "a", None), (None, "a", "x\ty z"), (3, "a", "w w w"), (3, "a", "w w w"), (no, "b", "")]


def test_targets_copies_and_words(spark):
    rows = made()
    df = ready(spark).createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", size int, mark string")
    got = mix(df).collect()
    assert len(got) == len(rows)
    assert Counter((r.doc_id, r.source, r["size"]) for r in got) == Counter((d, s, len((t or "").split(" ")) if t and "\t" not in t else 2 if t else 0) for d, s, t in rows)
    sizes = Counter()
    for r in got:
        sizes[r.source] += r["size"]
    goal = targets(sizes)
    for source, size in sizes.items():
        own = [r for r in got if r.source == source]
        assert {r.source_size for r in own} == {size}
        assert {round(r.target, 6) for r in own} == {round(goal[source], 6)}
        assert abs(sum(r.taken for r in own) - goal[source]) <= max(r["size"] for r in own)
    assert all(r.taken == r["size"] * r.copies and 0 <= r.copies <= 2 for r in got)


def test_same_copies_whatever_the_partitions(spark):
    df = ready(spark).createDataFrame(made(), SCHEMA)
    one = sorted(map(tuple, mix(df.repartition(1)).collect()), key=repr)
    assert one == sorted(map(tuple, mix(df.repartition(13)).collect()), key=repr)
    assert one != sorted(map(tuple, mix(df, seed=1).collect()), key=repr)


def test_the_mix_itself(spark):
    df = ready(spark).createDataFrame(made(), SCHEMA)
    drawn = mixed(df)
    assert drawn.columns == [*df.columns, "copy_no"]
    rows = drawn.collect()
    assert {r.copy_no for r in rows} == {1, 2}
    words = Counter()
    for r in rows:
        words[r.source] += len(r.text.split(" ")) if r.text else 0
    planned = Counter()
    for r in mix(df).collect():
        planned[r.source] += r.taken
    # rows are told apart by number instead of id: ties of size may fall otherwise, sums stay near
    assert all(abs(words[s] - planned[s]) <= 100 for s in planned)


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "a", ""), (2, "b", None)]])
def test_nothing_to_mix(spark, rows):
    got = mix(ready(spark).createDataFrame(rows, SCHEMA)).collect()
    assert [(r.taken, r.target) for r in got] == [(0, 0.0)] * len(rows)
