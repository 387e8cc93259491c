"""Compression classifiers: a pair of zstandard dictionaries and a calibrated logistic score."""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from martworks.llm.bytesmath import mix, shingles, words
from martworks.llm.common import logit

# bound of the labelled sample: rows per label
SAMPLE_ROWS = 2000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int = SAMPLE_ROWS):
    """(texts, labels, share of label 1 among all rows to learn from).

    At most `rows` documents per label, chosen by hash of the id, with their
    whole texts. The ids are chosen from the labels alone, so only the sample is
    joined (its size is bounded, so it is broadcast).
    """
    usable = labels.where(learn & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    counts = {r["y"]: r["n"] for r in usable.groupBy(F.col(label).alias("y")).agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return [], np.zeros(0), 1.0 if 1 in counts else 0.0
    by_label = [usable.where(F.col(label) == y).select("doc_id", F.lit(y).alias("y")).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(rows) for y in (0, 1)]
    chosen = by_label[0].unionByName(by_label[1]).groupBy("doc_id").agg(F.min("y").alias("y"))
    got = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id").select(
        "doc_id", "y", "text").toPandas()
    # one order whatever the tasks returned first
    got = got.sort_values(["doc_id", "text"], ignore_index=True)
    return list(got["text"]), got["y"].to_numpy(), counts[1] / (counts[0] + counts[1])


def distinct_texts(texts: list[str], keys: int = 4) -> np.ndarray:
    """Positions of texts that share no minimum of 3-word hashes with an earlier one: near copies count once.

    The hashes depend on nothing but the texts, so every session keeps the same ones.
    """
    seen: set = set()
    keep = []
    for i, text in enumerate(texts):
        grams = shingles(words(text), 3)
        low = {(k, int(mix(grams + np.uint64(k)).min()) if len(grams) else -1) for k in range(keys)}
        if not low & seen:
            keep.append(i)
        seen |= low
    return np.array(keep, int)


def logistic(features: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 40) -> np.ndarray:
    """Weights of a ridge logistic regression; the last feature is the constant."""
    w = np.zeros(features.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))
        step = np.linalg.solve((features.T * (p * (1 - p) + 1e-9)) @ features + ridge * np.eye(len(w)),
                               features.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Pair:
    """Dictionaries of two classes and the weights of the score; compressors are built in the task."""

    first: bytes
    second: bytes
    level: int
    weights: np.ndarray | None = None
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    _built: list = field(default_factory=list, repr=False, compare=False)

    def __getstate__(self):
        return {**self.__dict__, "_built": []}

    def sizes(self, windows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Compressed length of every window with either dictionary."""
        if not self._built:
            for body in (self.first, self.second):
                raw = zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                how = zstandard.ZstdCompressionParameters.from_level(
                    self.level, source_size=256, dict_size=len(body), min_match=3, write_content_size=False, write_dict_id=False)
                raw.precompute_compress(compression_params=how)
                self._built.append(zstandard.ZstdCompressor(compression_params=how, dict_data=raw))
        out = []
        for c in self._built:
            made = c.multi_compress_to_buffer(windows)
            out.append(np.fromiter((len(made[i]) for i in range(len(made))), np.int64, len(made)))
        return out[0], out[1]

    def calibrate(self, features: np.ndarray, y: np.ndarray, share: float) -> None:
        """Fits the score; the sample's label ratio is replaced by the ratio of all labelled rows."""
        self.mean, self.scale = features.mean(axis=0), features.std(axis=0) + 1e-9
        w = logistic(np.column_stack([(features - self.mean) / self.scale, np.ones(len(y))]), y)
        have, want = (min(max(p, 1e-3), 1 - 1e-3) for p in (y.mean(), share))
        w[-1] += logit(want) - logit(have)
        self.weights = w

    def score(self, features: np.ndarray) -> float:
        z = ((features - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + math.exp(-min(max(z, -30.0), 30.0)))


def trained(size: int, samples: list[bytes], segment: int) -> bytes:
    """Content of a trained dictionary; the samples themselves where they are too few to train on."""
    total = sum(map(len, samples))
    if total > 10 * size and len(samples) > 100:
        return zstandard.train_dictionary(size, samples, k=segment, d=8).as_bytes()
    return b" ".join(samples)[:size]


GRAM = 8
# a passage is told already if a found one holds so many bytes of its core
PIECE = 6


def _grams(text: str) -> tuple[bytes, np.ndarray]:
    """A text in single spaces and the number of each of its byte n-grams in order."""
    data = b" " + b" ".join(text.encode("utf-8", "replace").split()) + b" "
    raw = np.frombuffer(data, np.uint8).astype(np.uint64)
    n = max(0, len(raw) - GRAM + 1)
    out = np.zeros(n, np.uint64)
    for i in range(GRAM):
        out = (out << np.uint64(8)) | raw[i:i + n]
    return data, out


def contrast(own: list[str], other: list[str], size: int, least: float = 0.005, strength: float = 6.0) -> bytes:
    """Passages that far more texts of one class hold, the commonest last (nearest to what is compressed).

    Telling are the byte n-grams whose document frequencies differ; each is
    widened by the neighbours that nearly all of its texts show around it. One
    telling word makes an n-gram with every ordinary neighbour it has; it is held
    once, or the room would go to the few commonest words in all their contexts.
    """
    mine = [_grams(t) for t in own]
    gram, n = np.unique(np.concatenate([np.unique(g) for _, g in mine]), return_counts=True)
    keep = n >= max(2, least * len(own))
    gram, n = gram[keep], n[keep]
    there = np.zeros(len(gram))
    for text in other:
        there += np.isin(gram, _grams(text)[1])
    p, q = n / len(own), there / max(1, len(other))
    both = (n + there) / (len(own) + len(other))
    z = (p - q) / np.sqrt(both * (1 - both) * (1 / len(own) + 1 / max(1, len(other))) + 1e-12)
    good = (z >= strength) & (p > 3 * q)
    found: list[bytes] = []
    for _, core in sorted(((int(k), int(g).to_bytes(GRAM, "big")) for k, g in zip(n[good], gram[good])), reverse=True):
        pieces = [core[i:i + PIECE] for i in range(GRAM - PIECE + 1)]
        if any(piece in f for f in found for piece in pieces):
            continue
        passage = _extended(core, [data for data, _ in mine])
        if sum(map(len, found)) + len(passage) > size:
            break
        found.append(passage)
    return b" " + b"".join(reversed(found))


def _extended(core: bytes, texts: list[bytes], share: float = 0.8, most: int = 12) -> bytes:
    """A byte string with the neighbours that nearly all texts show around it."""
    around = []
    for data in texts:
        at = data.find(core)
        if at >= 0:
            around.append((data[max(0, at - most):at][::-1], data[at + len(core):at + len(core) + most]))
    sides = []
    for side in (0, 1):
        left, grown = [a[side] for a in around], b""
        for i in range(most):
            byte, count = Counter(x[i] for x in left if len(x) > i).most_common(1)[0] if any(len(x) > i for x in left) else (0, 0)
            if count < share * len(around):
                break
            grown += bytes([byte])
            left = [x for x in left if len(x) > i and x[i] == byte]
        sides.append(grown)
    return sides[0][::-1] + core + sides[1]
