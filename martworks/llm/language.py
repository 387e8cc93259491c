"""Language identification: averaged hashed subword embeddings and a linear softmax, trained by gradient descent in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from martworks.llm.bytesmath import U, mix
from martworks.llm.common import text_or_empty

BUCKETS = 8_192
GRAMS = (2, 3, 4)
DIM = 16
# bound of the labelled sample: rows over all languages, and the least per language
SAMPLE_ROWS = 4_000
LEAST_ROWS = 20
UNKNOWN = "und"
# share of rightly classified held-back texts that the rejection may lose
REJECT_SHARE = 0.001
STRETCH = 1_000_000


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def subword_counts(text: str) -> np.ndarray:
    """Counts of hashed byte n-grams of the whole text in lower case, spaces as word ends."""
    data = np.frombuffer(b" " + b" ".join(text.lower().encode("utf-8", "replace").split()) + b" ", np.uint8)
    out = np.zeros(BUCKETS, np.int64)
    # stretches overlap so that no n-gram is lost or counted twice
    for at in range(0, len(data), STRETCH):
        part = data[at:at + STRETCH + max(GRAMS) - 1].astype(np.uint64)
        for n in GRAMS:
            size = min(STRETCH, len(part) - n + 1)
            if size <= 0:
                continue
            h = np.full(size, n, np.uint64)
            for i in range(n):
                h = (h << U(8)) | part[i:i + size]
            out += np.bincount((mix(h) >> U(51)).astype(np.int64), minlength=BUCKETS)
    return out


@dataclass
class Model:
    """`table` is embeddings times softmax weights: one row of class scores per bucket."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    least: float = 0.0

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, calibrated probability, accepted."""
        if not has_letter(text):
            return UNKNOWN, 0.0, False
        counts = subword_counts(text)
        z = (counts @ self.table / max(1, counts.sum()) + self.bias) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] >= self.least)


def _shares(packed: list[bytes]) -> np.ndarray:
    """Shares of the buckets in some texts: a row per text, only for as many as a step needs."""
    out = np.zeros((len(packed), BUCKETS), np.float32)
    for i, body in enumerate(packed):
        n = len(body) // 6
        out[i, np.frombuffer(body[:2 * n], "<u2")] = np.frombuffer(body[2 * n:], "<u4")
    return out / out.sum(axis=1, keepdims=True)


def sample(docs: DataFrame, learn: Column) -> tuple[list[bytes], np.ndarray, list[str]]:
    """Packed subword counts and language numbers of a bounded labelled sample, the same number of rows per language at most."""
    usable = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    languages = sorted(r["lang"] for r in usable.select("lang").distinct().collect())
    if not languages:
        return [], np.zeros(0, int), []
    rows = max(LEAST_ROWS, SAMPLE_ROWS // len(languages))
    # ids first, texts only for those chosen (bounded, so broadcast)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = usable.select("doc_id", "lang").withColumn("place", F.row_number().over(order)).where(
        F.col("place") <= rows).select("doc_id").distinct()

    def run(frames):
        for frame in frames:
            out = []
            for text in frame["text"]:
                counts = subword_counts(text)
                at = np.flatnonzero(counts)
                out.append((at.astype("<u2").tobytes() + counts[at].astype("<u4").tobytes(), has_letter(text)))
            yield pd.DataFrame({"doc_id": frame["doc_id"], "lang": frame["lang"], "packed": [o[0] for o in out],
                                "ok": [o[1] for o in out]})

    got = usable.select("doc_id", "lang", "text").join(F.broadcast(chosen), "doc_id").mapInPandas(
        run, "doc_id long, lang string, packed binary, ok boolean").where("ok").toPandas()
    got = got.sort_values(["doc_id", "lang", "packed"], ignore_index=True)
    place = {lang: i for i, lang in enumerate(languages)}
    return list(got["packed"]), got["lang"].map(place).to_numpy(), languages


def train(docs: DataFrame, learn: Column, epochs: int = 12, batch: int = 64, rate: float = 8.0, seed: int = 5) -> Model:
    """Stochastic gradient descent on four fifths of the sample; the rest sets temperature and rejection bound."""
    packed, y, languages = sample(docs, learn)
    if not len(y):
        return Model([UNKNOWN], np.zeros((BUCKETS, 1)), np.zeros(1))
    rng = np.random.default_rng(seed)
    back = np.arange(len(y)) % 5 == 4
    learnt = np.flatnonzero(~back)
    k = len(languages)
    embed = rng.normal(0, 0.5, (BUCKETS, DIM)).astype(np.float32)
    weight, bias = np.zeros((DIM, k), np.float32), np.zeros(k, np.float32)
    steps, done = epochs * -(-len(learnt) // batch), 0
    for _ in range(epochs):
        rng.shuffle(learnt)
        for at in range(0, len(learnt), batch):
            own = learnt[at:at + batch]
            x = _shares([packed[i] for i in own])
            hidden = x @ embed
            z = hidden @ weight + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(own)), y[own]] -= 1
            p /= len(own)
            step = rate * (1 - done / steps)
            back_embed = x.T @ (p @ weight.T)
            weight -= step * hidden.T @ p
            # a bucket's share of an average is small, so its embedding takes a larger step
            embed -= step * 20 * back_embed
            bias -= step * 0.1 * p.sum(axis=0)
            done += 1
    model = Model(languages, (embed @ weight).astype(np.float64), bias.astype(np.float64))
    if back.any():
        held = np.flatnonzero(back)
        z = np.concatenate([_shares([packed[i] for i in held[at:at + batch]]) @ model.table for at in range(0, len(held), batch)]) + model.bias
        truth = y[back]

        def loss(t: float) -> float:
            s = z / t - (z / t).max(axis=1, keepdims=True)
            return float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(truth)), truth]))

        model.temperature = float(min(np.geomspace(0.05, 20, 60), key=loss))
        s = z / model.temperature
        p = np.exp(s - s.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        right = p.argmax(axis=1) == truth
        if right.any():
            model.least = float(min(np.quantile(p.max(axis=1)[right], REJECT_SHARE), 0.5))
    return model


def languages_of(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, accepted) of every whole text; `und` for null texts and texts without a letter."""
    def run(frames):
        for frame in frames:
            out = [model.predict(t) for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "lang_pred": [o[0] for o in out],
                                "score": [o[1] for o in out], "accepted": [o[2] for o in out]})
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        run, "doc_id long, lang_pred string, score double, accepted boolean")


def in_a_language(docs: DataFrame, model: Model) -> DataFrame:
    """The documents, all columns kept, whose language is accepted."""
    accepted = F.pandas_udf(lambda texts: pd.Series([model.predict(t)[2] for t in texts], dtype=bool), "boolean")
    return docs.where(accepted(F.coalesce("text", F.lit(""))))
