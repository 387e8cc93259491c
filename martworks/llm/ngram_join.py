"""Near-duplicate join on word n-grams: MinHash bands propose, full n-gram sets decide."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from martworks.llm.bytesmath import U, mix, shingles, words
from martworks.llm.common import components, ready, staged, text_or_empty
from martworks.llm.links import count_links

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
# n-grams compared in one task: two blocks of this size
BLOCK = 400_000
# documents compared in one task: two blocks of this size, so the matrix of a task is bounded however short the texts
BLOCK_DOCS = 2_000


def bands_and_rows(threshold: float, recall: float, most: int = 160) -> tuple[int, int]:
    """Most rows a band (so fewest false candidates) whose bands reach the recall at the threshold within `most` hashes.

    Where even single rows need more hashes, the recall counts and `most` gives way.
    """
    if threshold >= 1:
        return 1, 12
    for rows in range(1, 13):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-threshold ** rows))
        if rows == 1 or bands * rows <= most:
            best = (bands, rows)
    return best


def signature(grams: np.ndarray, count: int) -> np.ndarray:
    """MinHash values: the minima of `count` scramblings of the n-gram hashes."""
    seeds = mix(np.arange(1, count + 1, dtype=np.uint64))
    low = np.full(count, np.iinfo(np.uint64).max, np.uint64)
    odd = seeds | U(1)
    for at in range(0, len(grams), 2048):
        part = grams[at:at + 2048]
        low = np.minimum(low, (part[None, :] * odd[:, None] + seeds[:, None]).min(axis=1))
    return low


def _signed(n: int, bands: int, rows: int):
    def run(frames):
        for frame in frames:
            out = []
            for doc, key, text in zip(frame["doc_id"], frame["row_key"], frame["text"]):
                grams = shingles(words(text), n)
                if not len(grams):
                    out.append((doc, key, 0, 0, 0, []))
                    continue
                low = signature(grams, bands * rows).reshape(bands, rows)
                band = np.arange(bands, dtype=np.uint64)
                for i in range(rows):
                    band = mix(band * U(0x9FB21C651E98DF25) + low[:, i])
                set_hash = mix(grams).sum(), mix(grams ^ U(0x5DEECE66D)).sum()
                out.append((doc, key, len(grams), *(int(x.astype(np.int64)) for x in set_hash), band.view(np.int64).tolist()))
            if out:
                yield pd.DataFrame(out, columns=["doc_id", "row_key", "grams", "h1", "h2", "bands"]).astype({"doc_id": "Int64"})
    return run


def _sets(n: int):
    def run(frames):
        for frame in frames:
            frame["body"] = [shingles(words(t), n).tobytes() for t in frame["text"]]
            yield frame.drop(columns="text")
    return run


def jaccard(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Exact Jaccard of every pair of n-gram sets, by products over the n-grams that occur twice at least."""
    sets = [np.frombuffer(x, np.uint64) for x in (*left, *right)]
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    gram, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = count[inverse] > 1
    column = (np.cumsum(count > 1) - 1)[inverse[keep]]
    owner = owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    both = np.zeros((len(left), len(right)), np.float32)
    step = max(64, 4_000_000 // len(sets))
    for at in range(0, int((count > 1).sum()), step):
        own = slice(*np.searchsorted(column, [at, at + step]))
        has = np.zeros((len(sets), step), np.float32)
        has[owner[own], column[own] - at] = 1
        both += has[:len(left)] @ has[len(left):].T
    union = size[:len(left), None] + size[None, len(left):] - both
    return both.astype(np.float64) / union


def near_duplicates(docs: DataFrame, n: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL,
                    extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id its links reach, itself included), n_links (other
    documents with n-gram Jaccard >= threshold), same_id (smallest doc_id with the same n-gram set), kept.

    Words are runs of letters, digits and non-ASCII characters in lower case.
    A text of fewer words than n is one n-gram; a null, empty or wordless text
    links with nothing. Equal n-gram sets are one class with a count, so copies
    are never paired. Bands and rows follow from the wanted recall at the
    threshold; buckets of any size are handled: their members are joined to the
    smallest, and the resulting groups are compared in blocks. A null doc_id is
    returned with a null class and no links unless it shares its n-gram set with
    a document that has an id. Repeated rows count as documents. `extra` may name
    row_key, the hash of the text, to tell apart rows that share an id.
    """
    spark = ready(docs.sparkSession)
    bands, rows = bands_and_rows(threshold, recall)
    text = text_or_empty()
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("row_key"))
    signed = staged(plain.mapInPandas(
        _signed(n, bands, rows), "doc_id long, row_key long, grams long, h1 long, h2 long, bands array<long>"))
    classes = staged(signed.where("grams > 0").groupBy("h1", "h2").agg(
        F.min(F.struct("doc_id", "row_key")).alias("low"), F.min("doc_id").alias("id"), F.count("*").alias("copies"),
        F.first("grams").alias("grams"), F.first("bands").alias("bands")).where("id is not null"))
    banded = classes.select("id", F.posexplode("bands").alias("band", "hash"))
    buckets = banded.groupBy("band", "hash").agg(F.min("id").alias("low"), F.count("*").alias("n")).where("n > 1")
    near = banded.join(buckets, ["band", "hash"]).where("id <> low").select(F.col("id").alias("u"), F.col("low").alias("v"))
    groups = staged(components(near))
    # the smallest row of a class stands for it; ids are unique among classes unless rows share an id
    chosen = groups.select(F.col("node").alias("id"), F.col("component").alias("grp")).join(
        classes.select("id", "copies", "grams", "h1", "h2"), "id")
    bearer = signed.select("doc_id", "row_key", "h1", "h2").join(
        chosen.select("id", "grp", "copies", "grams", "h1", "h2"), ["h1", "h2"]).where("doc_id = id").dropDuplicates(["h1", "h2"])
    members = plain.join(bearer, ["doc_id", "row_key"]).dropDuplicates(["h1", "h2"]).select(
        "grp", "id", "copies", "grams", "text").mapInPandas(
        _sets(n), "grp long, id long, copies long, grams long, body binary").withColumn(
        "weight", F.greatest(F.col("grams"), F.lit(-(-BLOCK // BLOCK_DOCS))))
    linked = staged(count_links(members, "weight", BLOCK, jaccard, threshold))
    edges = linked.select(F.col("id").alias("u"), F.explode("roots").alias("v"))
    found = staged(components(edges))
    per_class = classes.join(linked.groupBy("id").agg(F.sum("links").alias("links")), "id", "left").join(
        found.select(F.col("node").alias("id"), "component"), "id", "left").select(
        "h1", "h2", F.col("id").alias("same_id"), F.coalesce("component", "id").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return signed.select("doc_id", "row_key", "h1", "h2", "grams").join(per_class, ["h1", "h2"], "left").select(
        "doc_id", *extra, F.when(F.col("grams") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("grams") > 0, F.col("same_id")).otherwise(F.col("doc_id")).alias("same_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))


def one_of_each(docs: DataFrame, n: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns kept, without those that reach a smaller doc_id.

    Rows go by id and text: of two rows that share an id only the one that is
    linked goes. Repeated rows of one id and text stay or go together; rows
    without id, text or words stay; an empty table stays empty; texts are compared
    whole and columns of any name are kept.
    """
    gone = near_duplicates(docs, n, threshold, extra=("row_key",)).where("not kept").select(
        F.col("doc_id").alias("__gone_id"), F.col("row_key").alias("__gone_key")).distinct()
    return docs.join(gone, (F.col("doc_id") == F.col("__gone_id")) & (F.xxhash64(text_or_empty()) == F.col("__gone_key")), "left_anti")
