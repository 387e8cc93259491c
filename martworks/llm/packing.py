"""Packing by lexical retrieval: a sharded BM25 index offers unused neighbours that fill each seed's window.

1. Every document is tokenised once; ids, counts and a MinHash of its distinct
   ids are written.
2. Document frequencies of all ids are summed over the whole corpus (one row
   per vocabulary entry).
3. Documents are range-partitioned by MinHash, so that lexically close ones
   share a shard; a hot group is an ordinary range that is cut where a shard is
   full, because the document id is part of the key.
4. In a shard an inverted index with BM25 weights is built. A seed document
   opens a window of `window` tokens, its best unused neighbours are appended
   until the window is full; the piece that does not fit opens the next window.
   So every window but the last of a shard is full.
"""

from __future__ import annotations

import base64
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from martworks.llm.bytesmath import U, mix
from martworks.llm.common import ready, staged, text_or_empty

WINDOW = 2048
END_ID = 1
# characters from which ids come in a buffer
LONG_TEXT = 1 << 20
# tokens of a shard: a few thousand documents, tens of MB with its index
SHARD_TOKENS = 2_000_000
# Texts that the vocabulary has as one token.
SPECIAL = {"<|endoftext|>": 50256}
# documents of one inverted index inside a shard
INDEX_DOCS = 256
K1, B = 1.2, 0.75


@lru_cache(maxsize=2)
def encoder(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    known = set(ranks.values())
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={
        text: i for text, i in SPECIAL.items() if i not in known})


def token_ids(enc: tiktoken.Encoding, text: str) -> np.ndarray:
    """Ids of a text and the end id. The call by list is faster, the one by buffer holds long texts in less memory."""
    if any(s in text for s in enc.special_tokens_set):
        return np.array([*enc.encode(text, allowed_special="all"), END_ID], np.uint32)
    if len(text) < LONG_TEXT:
        return np.array([*enc.encode_ordinary(text), END_ID], np.uint32)
    return np.append(enc.encode_to_numpy(text, disallowed_special=()), np.uint32(END_ID))


def _id_hash(ids: np.ndarray) -> np.ndarray:
    return mix(ids.astype(np.uint64) * U(0x9FB21C651E98DF25))


def tokenised(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, ids, n, sketch): uint16 or wider ids of each text and the end id, their count, a MinHash of the ids."""
    def run(frames):
        enc = encoder(ranks_path, pattern)
        hashes = _id_hash(np.arange(enc.n_vocab))
        for frame in frames:
            out = []
            for text in frame["text"]:
                ids = token_ids(enc, text)
                sketch = hashes[ids].min() >> U(1)
                out.append((ids.astype("<u2").tobytes() if ids.max() < 65536 else b"\0" + ids.astype("<u4").tobytes(),
                            len(ids), int(sketch)))
            if out:
                yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"),
                                    **dict(zip(("ids", "n", "sketch"), map(list, zip(*out))))})
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInPandas(
        run, "doc_id long, ids binary, n long, sketch long")


def unpack(ids: bytes) -> np.ndarray:
    """Ids as uint32; an odd length marks the wide form."""
    return np.frombuffer(ids[1:], "<u4") if len(ids) % 2 else np.frombuffer(ids, "<u2").astype(np.uint32)


def document_frequencies(tokens: DataFrame) -> tuple[np.ndarray, int, int]:
    """Documents per id, number of documents and of tokens; one partial vector per task, summed by Spark."""
    def run(frames):
        df = np.zeros(1 << 16, np.int64)
        docs = total = 0
        for frame in frames:
            for ids in frame["ids"]:
                ids = unpack(ids)
                seen = np.unique(ids)
                if seen[-1] >= len(df):
                    df = np.concatenate([df, np.zeros(int(seen[-1]) + 1 - len(df), np.int64)])
                df[seen] += 1
                docs, total = docs + 1, total + len(ids)
        at = np.flatnonzero(df)
        yield pd.DataFrame({"id": np.append(at, [-1, -2]), "n": np.append(df[at], [docs, total])})
    rows = tokens.select("ids").mapInPandas(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    n = dict(zip(rows["id"], rows["n"]))
    docs, total = int(n.pop(-1, 0)), int(n.pop(-2, 0))
    df = np.zeros(max(n, default=0) + 1, np.int64)
    df[list(n)] = list(n.values())
    return df, docs, total


class Index:
    """Inverted index with BM25 weights over some documents; queries name one of them."""

    def __init__(self, ids: list[np.ndarray], df: np.ndarray, n_docs: int, mean: float):
        doc = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
        key = np.sort(np.concatenate(ids).astype(np.uint32) * np.uint32(len(ids)) + doc.astype(np.uint32))
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        count, key = np.diff(np.append(first, len(key))), key[first]
        self.n, self.term, self.doc = len(ids), (key // len(ids)).astype(np.int64), (key % len(ids)).astype(np.int64)
        length = np.array([len(x) for x in ids])[self.doc]
        idf = np.log1p((n_docs - df[self.term] + 0.5) / (df[self.term] + 0.5))
        self.weight = idf * count * (K1 + 1) / (count + K1 * (1 - B + B * length / mean))
        head = np.flatnonzero(np.concatenate([[True], self.term[1:] != self.term[:-1]]))
        # postings of a term lie together; each posting knows where its term's list starts and how long it is
        size = np.diff(np.append(head, len(key)))
        slot = np.repeat(np.arange(len(head)), size)
        self.head, self.size = head, size
        own = np.argsort(self.doc, kind="stable")
        self.own, self.bounds = slot[own], np.searchsorted(self.doc[own], np.arange(len(ids) + 1))

    def scores(self, doc: int) -> np.ndarray:
        """BM25 of every document for the distinct ids of `doc`."""
        slots = self.own[self.bounds[doc]:self.bounds[doc + 1]]
        size = self.size[slots]
        at = np.arange(size.sum()) + np.repeat(self.head[slots] - np.append(0, np.cumsum(size)[:-1]), size)
        return np.bincount(self.doc[at], self.weight[at], self.n)


def fill(ids: list[np.ndarray], index: Index, window: int, last: tuple | None, emit) -> tuple:
    """Fills windows with the documents of one index, from the open window (sequence, used tokens); returns the open one.

    emit(document, start, length, sequence, offset) is called per piece.
    """
    sequence, used = last or (0, 0)
    unused = np.ones(len(ids), bool)
    order: list[int] = []
    seed = 0
    while unused.any():
        if not order:
            while not unused[seed]:
                seed += 1
            order = [seed]
        doc = order.pop(0)
        if not unused[doc]:
            continue
        unused[doc] = False
        start = 0
        fresh = used == 0
        while start < len(ids[doc]):
            take = min(window - used, len(ids[doc]) - start)
            emit(doc, start, take, sequence, used)
            start, used = start + take, used + take
            if used == window:
                sequence, used, fresh = sequence + 1, 0, True
        if fresh and used:
            # this document opens the window: its neighbours come next
            score = index.scores(doc)
            score[~unused] = -1
            order = [i for i in np.argsort(-score, kind="stable").tolist() if unused[i]]
    return sequence, used


def _shard(df: np.ndarray, n_docs: int, mean: float, window: int):
    def run(frames):
        frame = pd.concat([pd.DataFrame(columns=["doc_id", "ids", "n", "sketch"]), *frames], ignore_index=True)
        if not len(frame):
            return
        frame = frame.sort_values(["sketch", "doc_id", "n"], kind="stable", ignore_index=True)
        out, last = [], None
        for at in range(0, len(frame), INDEX_DOCS):
            part = frame.iloc[at:at + INDEX_DOCS]
            ids = [unpack(x) for x in part["ids"]]
            doc_id, n = part["doc_id"].tolist(), part["n"].tolist()

            def emit(doc, start, length, sequence, offset):
                piece = ids[doc][start:start + length]
                out.append((doc_id[doc], start, length, zlib.crc32(piece.astype("<u4").tobytes()), n[doc], sequence, offset))

            last = fill(ids, Index(ids, df, n_docs, mean), window, last, emit)
        pieces = pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
        pieces["sequence_id"] += TaskContext.get().partitionId() << 32
        yield pieces.astype({"doc_id": "Int64"})
    return run


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, ranks_path: str, pattern: str, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Pieces of all documents in sequences of at most `window` tokens: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.

    Only doc_id and text are read. A null text is empty: its one piece is the
    end id. Special-token strings in a text are ordinary text. A null doc_id is
    kept. Repeated rows are packed each. An empty table gives no rows. Only the
    last sequence of a shard can be short. A shard holds about `shard_tokens`
    tokens, or one document if that is longer.
    """
    ready(docs.sparkSession)
    tokens = staged(tokenised(docs, ranks_path, pattern))
    df, n_docs, total = document_frequencies(tokens)
    shards = max(1, round(total / shard_tokens))
    return tokens.repartitionByRange(shards, "sketch", "doc_id").mapInPandas(
        _shard(df, n_docs, total / max(1, n_docs), window), PIECES)
