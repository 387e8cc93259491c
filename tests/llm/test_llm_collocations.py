"""Collocations against a brute-force count."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from martworks.llm import collocations as module
from martworks.llm.collocations import collocations
from martworks.llm.common import ready

SCHEMA = "doc_id long, lang string, text string"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, least, top=2000, absorb=100):
    count, total = Counter(), Counter()
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            total[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    count[lang, tuple(words[i:i + k])] += 1
    out = []
    kept = {key: a for key, a in count.items() if a >= least and len(key[1]) > 1}
    longer = {}
    for (lang, p), a in kept.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                key = lang, p[i:i + k]
                longer[key] = max(longer.get(key, 0), a)
    for (lang, p), a in kept.items():
        if 100 * longer.get((lang, p), 0) >= absorb * a:
            continue
        cuts = []
        for k in range(1, len(p)):
            left, right = count[lang, p[:k]], count[lang, p[k:]]
            cuts.append((1000 * a * total[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.append((lang, -score, -a, " ".join(p).encode(), left, right, total[lang]))
    done, place = [], Counter()
    for lang, score, a, p, left, right, n in sorted(out):
        place[lang] += 1
        if place[lang] <= top:
            done.append((lang, place[lang], p.decode(), -a, left, right, n, -score))
    return done


def made(seed=3):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "é", "ZED", "日本", "z z"]
    rows = []
    for i in range(120):
        words = [rnd.choice(vocabulary[:3 + i % 33]) for _ in range(rnd.randint(0, 60))]
        text = "".join(w + rnd.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", " ", " "]) for w in words)
        rows.append((i, rnd.choice(["en", "de", None, "und", ""]), text + " the very common phrase of all" * (i % 4)))
    rows += [(200, "en", "a a a a a a a a"), (201, "en", None), (202, None, ""), (203, "de", "no separators here " * 3), (200, "en", "a a a a a a a a")]
    return rows


@pytest.mark.parametrize("least,top,absorb", [(5, 2000, 100), (3, 7, 60)])
def test_collocations_are_the_brute_force_ones(spark, least, top, absorb):
    rows = made()
    df = ready(spark).createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", n int, words string")
    got = sorted(map(tuple, collocations(df, least, top, absorb).collect()))
    assert got == sorted(brute(rows, least, top, absorb))
    assert len(got) > 20


def test_heavy_prefixes_are_split_and_long_texts_stepped(spark):
    # nearly all suffixes begin with one pair, two thirds of them with one triple
    rnd = random.Random(8)
    parts = [f"hot pair {rnd.choice(['same', 'same', 'other'])} {rnd.choice('abc')} {rnd.choice('de')}." for _ in range(60_000)]
    rows = [(1, "en", "".join(parts)), (2, "en", "x" * 3_000_000 + " hot pair"), (3, "de", "hot pair")]
    df = ready(spark).createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, collocations(df, 100).collect()))
    assert got == sorted(brute(rows, 100))


def test_steps_cover_the_text():
    import numpy as np
    text = b"a" * 5 + b"." + b"b" * (3 * module.STEP_BYTES) + b".c" * 1_000_000
    bounds = np.array([0, 3, 3, len(text) - 7, len(text)], np.int64)
    steps = list(module._steps(np.frombuffer(text, np.uint8), bounds))
    assert steps[0][0] == 0 and steps[-1][1] == len(text)
    assert all(a[1] == b[0] for a, b in zip(steps, steps[1:]))


def test_empty_table(spark):
    assert collocations(ready(spark).createDataFrame([], SCHEMA)).count() == 0
