"""Words that are cut in known pieces get the ids that the fold gives them."""

from __future__ import annotations

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from martworks.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_cut_words(spark, monkeypatch):
    ranks = bpe.read_ranks(PATH)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    parts = ["th", "tion", "nt", "ly", "er", "ein", "heit", "ción", "ñí", "éa", "ung"]
    seen = spark.createDataFrame([(i, " ".join(a + b + c for c in parts for b in parts)) for i, a in enumerate(parts)],
                                 "doc_id long, text string")
    coder = bpe.Coder(PATH, public_tokenizers.PATTERN)
    known = coder.frequent(seen)
    new = [f" {a}{b}{c}{d}" for a in parts for b in parts for c in parts for d in parts[:4]]
    rows = spark.createDataFrame([(w,) for w in new], "text string").repartition(4)
    for r in rows.select("text", coder.encode(F.col("text"), known).alias("ids")).collect():
        assert r.ids == ",".join(map(str, enc.encode_ordinary(r.text))), r.text
    # and most of them without a fold
    monkeypatch.setattr(bpe, "fold_word", lambda word, rank: F.lit("fold"))
    folded = rows.where(coder.encode(F.col("text"), known).contains("fold")).count()
    assert folded < len(new) / 2
