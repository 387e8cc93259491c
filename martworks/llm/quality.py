"""Quality by compression: the normalised difference of compressed sizes with a good and a bad dictionary."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from martworks.llm.common import text_or_empty
from martworks.llm.compression import Pair, distinct_texts, labelled_sample, trained

WINDOW_BYTES = 256
DICTIONARY_BYTES = 48_000
STRETCH = 2_048
THRESHOLD = 0.7


def windows(text: str) -> list[bytes]:
    data = text.encode("utf-8", "replace") or b" "
    return [data[i:i + WINDOW_BYTES] for i in range(0, max(1, len(data)), WINDOW_BYTES)]


def features(pair: Pair, text: str) -> np.ndarray:
    """Size difference over raw size: of the whole text, of its most bad-like and most good-like windows; how well the good
    dictionary does; length."""
    parts = windows(text)
    good, bad = (np.concatenate(x) for x in zip(*(pair.sizes(parts[at:at + STRETCH]) for at in range(0, len(parts), STRETCH))))
    raw = np.array([len(p) + 1 for p in parts])
    each = (bad - good) / raw
    return np.array([(bad - good).sum() / raw.sum(), each.min(), each.max(), good.sum() / raw.sum(), np.log(raw.sum())])


def train(docs: DataFrame, labels: DataFrame, learn: Column) -> Pair:
    """Dictionaries from one half of the bounded labelled sample, score weights from the other."""
    texts, y, share = labelled_sample(docs, labels, "quality", learn)
    if not len(y) or len(set(y)) < 2:
        pair = Pair(b" ", b" ", 3)
        pair.weights, pair.mean, pair.scale = np.zeros(6), np.zeros(5), np.ones(5)
        pair.weights[-1] = -30.0 if share == 0.0 and len(y) else 30.0
        return pair
    keep = distinct_texts(texts)
    half = keep[::2]
    good, bad = ([w for i in half if y[i] == c for w in windows(texts[i])] for c in (1, 0))
    pair = Pair(trained(DICTIONARY_BYTES, good, 64), trained(DICTIONARY_BYTES, bad, 64), 3)
    rest = keep[1::2] if len(set(y[keep[1::2]])) == 2 else keep
    pair.calibrate(np.array([features(pair, texts[i]) for i in rest]), y[rest], share)
    return pair


def quality_scores(docs: DataFrame, pair: Pair, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) of every whole text; a null text counts as empty, a null doc_id stays null."""
    def run(frames):
        for frame in frames:
            score = [pair.score(features(pair, t)) for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "score": score,
                                "predicted": [int(s >= threshold) for s in score]})
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInPandas(
        run, "doc_id long, score double, predicted int")
