"""Toxicity by compression distance: how much shorter does a window get with the toxic dictionary?"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from martworks.llm.common import text_or_empty
from martworks.llm.compression import Pair, contrast, distinct_texts, labelled_sample, trained

WINDOW_WORDS = 8
ORDINARY_BYTES = 60_000
TOXIC_BYTES = 2_048
# windows compressed at once
STRETCH = 4_096
THRESHOLD = 0.5


def windows(text: str) -> list[bytes]:
    """Neighbouring words in groups of WINDOW_WORDS, lower case; a very long word is cut."""
    words = text.lower().encode("utf-8", "replace").split()
    if words and max(map(len, words)) > 128:
        words = [w[i:i + 64] for w in words for i in range(0, len(w), 64)]
    return [b" " + b" ".join(words[i:i + WINDOW_WORDS]) + b" " for i in range(0, max(1, len(words)), WINDOW_WORDS)]


def features(pair: Pair, text: str) -> np.ndarray:
    """Bytes that the toxic dictionary saves: best windows, telling windows, all savings, net savings, length."""
    parts = windows(text)
    gain = []
    for at in range(0, len(parts), STRETCH):
        ordinary, toxic = pair.sizes(parts[at:at + STRETCH])
        gain.append(ordinary - toxic)
    gain = np.concatenate(gain)
    up = np.clip(gain, 0, None)
    top = np.sort(up)[::-1][:3]
    return np.array([top.sum() / 3, np.log1p((gain >= 2).sum()), np.log1p(up.sum()), gain.sum() / np.sqrt(len(gain)),
                     np.log(len(gain))])


def train(docs: DataFrame, labels: DataFrame, learn: Column) -> Pair:
    """Dictionaries from three quarters of the bounded labelled sample, score weights from the last one.

    The ordinary dictionary is trained on ordinary windows. The toxic one holds
    the same ordinary text, so that common words cost alike, and behind it what
    sets toxic texts apart: passages found in far more of them. (A dictionary that
    zstandard trains on toxic windows fills up with frequent ordinary syllables.)
    """
    texts, y, share = labelled_sample(docs, labels, "toxic", learn)
    if not len(y) or len(set(y)) < 2:
        pair = Pair(b" ", b" ", 3)
        pair.weights, pair.mean, pair.scale = np.zeros(6), np.zeros(5), np.ones(5)
        pair.weights[-1] = 30.0 if share == 1.0 and len(y) else -30.0
        return pair
    low = [t.lower() for t in texts]
    keep = distinct_texts(low)
    last = np.arange(len(keep)) % 4 == 3
    told = keep[~last]
    toxic, ordinary = ([low[i] for i in told if y[i] == c] for c in (1, 0))
    base = trained(ORDINARY_BYTES, [w for t in ordinary for w in windows(t)], 32)
    pair = Pair(base, base + contrast(toxic, ordinary, TOXIC_BYTES), 3)
    rest = keep[last] if len(set(y[keep[last]])) == 2 else keep
    pair.calibrate(np.array([features(pair, texts[i]) for i in rest]), y[rest], share)
    return pair


def toxic_scores(docs: DataFrame, pair: Pair, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) of every whole text; a null text counts as empty, a null doc_id stays null."""
    def run(frames):
        for frame in frames:
            score = [pair.score(features(pair, t)) for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "score": score,
                                "predicted": [int(s >= threshold) for s in score]})
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInPandas(
        run, "doc_id long, score double, predicted int")


def not_toxic(docs: DataFrame, pair: Pair, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns kept, whose text scores below the threshold."""
    score = F.pandas_udf(lambda texts: pd.Series([pair.score(features(pair, t)) for t in texts]), "double")
    return docs.where(score(text_or_empty()) < threshold)
