"""Faults that earlier versions had."""

from __future__ import annotations

import os
import subprocess
import sys

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from martworks.llm.common import ready
from martworks.llm.compression import contrast
from martworks.llm.language import _shares, subword_counts
from martworks.llm.ngram_join import one_of_each
from martworks.llm.packing import END_ID, encoder, token_ids

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_KEPT = """
import random
from martworks.llm.compression import contrast, distinct_texts
r = random.Random(1)
texts = [" ".join(r.choice("abcdefgh") * r.randint(1, 3) for _ in range(r.randint(0, 30))) for _ in range(400)]
print(distinct_texts(texts).tolist(), contrast(["a nasty word " + t for t in texts[:200]], texts[200:], 500))
"""


def test_every_session_learns_alike():
    out = {subprocess.run([sys.executable, "-c", _KEPT], cwd=ROOT, env={**os.environ, "PYTHONPATH": ROOT, "PYTHONHASHSEED": seed},
                          capture_output=True, text=True, check=True).stdout for seed in ("1", "2")}
    assert len(out) == 1 and "nasty" in out.pop()


def test_a_common_telling_word_leaves_room_for_rarer_ones():
    plain = [f"{a}{b}{c} {c}{a}{b}" for a in "klmnpr" for b in "aeiou" for c in "stvwz"]
    rows = [" ".join(plain[(i * k) % len(plain)] for k in (3, 7, 11, 13, 17)) for i in range(400)]
    # one word in many contexts, three in a tenth of the texts each
    own = [f"{t} {plain[i % 29][:3]} scoundrel {plain[i % 31][:3]} {'knavery gallows villain'.split()[i % 3] if i % 3 == i % 10 % 3 else ''}"
           for i, t in enumerate(rows[:300])]
    body = contrast(own, rows, 120)
    assert len(body) <= 121 and all(piece in body for piece in (b"scound", b"knaver", b"gallow", b"villai"))


def test_one_of_each_drops_rows_not_ids(spark):
    a = "one two three four five six seven eight nine ten eleven twelve"
    b = "quite another text with other words that nothing else in here has"
    rows = [(1, a), (7, a), (7, b), (None, a), (8, None), (9, "")]
    df = ready(spark).createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, row_key int, _gone string")
    got = one_of_each(df)
    assert got.columns == df.columns
    assert sorted(((r.doc_id or 0), r.text or "") for r in got.collect()) == sorted([(1, a), (7, b), (0, a), (8, ""), (9, "")])
    assert one_of_each(df.where("false")).count() == 0


def test_end_of_text_is_one_id_as_in_the_tokenizers_file():
    enc = encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("foo <|endoftext|> bar", "<|endoftext|>", "<|endoftext|><|endoftext|> a", "plain text", ""):
        assert token_ids(enc, text).tolist() == [*reference.encode(text, add_special_tokens=False).ids, END_ID]


def test_shares_come_from_packed_counts():
    counts = [subword_counts(t) for t in ("some text here", "ein anderer Text")]
    packed = []
    for c in counts:
        at = np.flatnonzero(c)
        packed.append(at.astype("<u2").tobytes() + c[at].astype("<u4").tobytes())
    assert np.allclose(_shares(packed), np.array([c / c.sum() for c in counts]))
