"""Collocations: phrases of two to five words that meet more often than their parts would by chance.

Counting follows vertical partitioning of a suffix tree. A first scan counts
prefixes of one word, a second one those of two words; prefixes too rare for any
phrase are dropped. Every other prefix begins suffixes, cut off after five words
or before the first rare pair. A third scan deals them to groups by their first
words: two of them, and more where a prefix has more suffixes than a group may
hold. A group is sorted on its own; neighbouring suffixes that agree in their
first k words form a node of depth k, and its count is the total of its leaves.
Suffixes of one batch that agree wholly travel as one with a count.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from martworks.llm.bytesmath import U, mix, prefix, slices
from martworks.llm.common import staged, text_or_empty
from martworks.session import work_partitions

DEPTH = 5
# words that a group is planned for, words counted and words dealt at once, bytes of one step
GROUP_WORDS, COUNT_WORDS, DEAL_WORDS, STEP_BYTES = 1_000_000, 2_000_000, 1_200_000, 1 << 20
# fixed sizes of what tasks are told: bits that mark frequent words, frequent pairs, and heavy prefixes of 2, 3 and 4 words
WORD_BITS, PAIR_BITS, CELL_BITS = 23, 25, 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# 0: in a word, 1: between words, 2: between pieces
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 32]] = 1
_KIND[[10, 11, 12, 13, *b".,;:!?"]] = 2
_FOLD = U(0x9FB21C651E98DF25)


def _lang_key(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big")


class Words:
    """Words in order of place: hash (of language and word), whether the next one is in the same piece, and where the bytes are."""

    def __init__(self, low: np.ndarray, first: np.ndarray, stop: np.ndarray, doc: np.ndarray, hashes: np.ndarray, joined: np.ndarray):
        self.low, self.first, self.stop, self.doc, self.hashes, self.joined = low, first, stop, doc, hashes, joined


def _steps(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about STEP_BYTES that end with a document or a piece."""
    at, end = int(bounds[0]), int(bounds[-1])
    while at < end:
        to = min(at + STEP_BYTES, end)
        if to < end:
            whole = int(bounds[np.searchsorted(bounds, to, "right") - 1])
            if whole > at:
                to = whole
            else:
                breaks = np.flatnonzero(_KIND[data[at:to]] == 2)
                if len(breaks):
                    to = at + int(breaks[-1]) + 1
                else:  # one piece longer than a step
                    stop = int(bounds[np.searchsorted(bounds, at, "right")])
                    while to < stop:
                        breaks = np.flatnonzero(_KIND[data[to:to + STEP_BYTES]] == 2)
                        if len(breaks):
                            to = to + int(breaks[0]) + 1
                            break
                        to += STEP_BYTES
                    to = min(to, stop)
        yield at, to
        at = to


def words_of(batch: pa.RecordBatch) -> Iterator[tuple[list[str], Words]]:
    """The words of a batch (lang, text), step by step; `doc` is the row in the batch."""
    langs = batch.column(0).to_pylist()
    keys = {lang: _lang_key(lang) for lang in set(langs)}
    lang_hash = np.array([keys[x] for x in langs], np.uint64)
    body = batch.column(1).cast(pa.binary()) if pa.types.is_string(batch.column(1).type) else batch.column(1).cast(pa.large_binary())
    wide = np.int64 if pa.types.is_large_binary(body.type) else np.int32
    _, where, store = body.buffers()
    bounds = np.frombuffer(where, wide)[body.offset:body.offset + len(body) + 1].astype(np.int64)
    if store is None or bounds[-1] == bounds[0]:
        return
    data = np.frombuffer(store, np.uint8)
    for a, b in _steps(data, bounds):
        low = _LOWER[data[a:b]]
        kind = _KIND[low]
        inside = kind == 0
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        heads = bounds[(bounds >= a) & (bounds < b)] - a
        first[heads] = inside[heads]
        ends = heads[heads > 0] - 1
        last[ends] = inside[ends]
        start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
        if not len(start):
            continue
        doc = np.searchsorted(bounds, start + a, "right") - 1
        piece = np.cumsum(kind == 2, dtype=np.int32)[start]
        joined = np.zeros(len(start), bool)
        joined[:-1] = (doc[1:] == doc[:-1]) & (piece[1:] == piece[:-1])
        hashes = mix(slices(prefix(low), start, stop) + lang_hash[doc])
        yield langs, Words(low, start, stop, doc, hashes, joined)


def _fold(upto: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(upto * _FOLD + word)


def _cell(key: np.ndarray) -> np.ndarray:
    return (key >> U(64 - CELL_BITS)).astype(np.int64)


def _marked(bits: np.ndarray, cell: np.ndarray) -> np.ndarray:
    return (bits[cell >> 3] >> (cell & 7).astype(np.uint8)) & np.uint8(1) != 0


def _count_words(share: float):
    """Counts of all words, words per language, and the cells of prefixes that hold more than a part of the batch."""
    schema = pa.schema([("kind", pa.int32()), ("lang", pa.string()), ("word", pa.binary()), ("h", pa.int64()), ("n", pa.int64())])

    def flush(found: list, cells: list[np.ndarray], seen: int):
        lows = [f[0] for f in found]
        step = np.concatenate([np.full(len(f[1]), i) for i, f in enumerate(found)])
        hashes, count, start, stop = (np.concatenate([f[i] for f in found]) for i in (1, 2, 3, 4))
        langs = [x for f in found for x in f[5]]
        once, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        total = np.bincount(which, weights=count).astype(np.int64)
        word = [lows[s][a:b].tobytes() for s, a, b in zip(step[at].tolist(), start[at].tolist(), stop[at].tolist())]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.ones(len(once), np.int32)), pa.array([langs[i] for i in at.tolist()], pa.string()), pa.array(word, pa.binary()),
            pa.array(once.view(np.int64)), pa.array(total)], schema=schema)
        for k, counted in enumerate(cells):
            heavy = np.flatnonzero(counted >= max(2, share * seen / 2))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(heavy), k + 2, np.int32)), pa.nulls(len(heavy), pa.string()), pa.nulls(len(heavy), pa.binary()),
                pa.array(heavy), pa.array(counted[heavy])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, seen, cells, per_lang = [], 0, None, {}
        for batch in batches:
            for langs, w in words_of(batch):
                if cells is None:
                    cells = [np.zeros(1 << CELL_BITS, np.int64) for _ in range(DEPTH - 2)]
                once, at, count = np.unique(w.hashes, return_index=True, return_counts=True)
                found.append((w.low, once, count, w.first[at], w.stop[at], [langs[i] for i in w.doc[at].tolist()]))
                rows, n = np.unique(w.doc, return_counts=True)
                for row, k in zip(rows.tolist(), n.tolist()):
                    per_lang[langs[row]] = per_lang.get(langs[row], 0) + k
                key, alive = w.hashes, w.joined
                for k in range(DEPTH - 2):
                    key = _fold(key[:-1], w.hashes[k + 1:])
                    alive = w.joined[:len(key)] if k == 0 else alive[:-1] & w.joined[k:k + len(key)]
                    cells[k] += np.bincount(_cell(key[alive]), minlength=1 << CELL_BITS)
                seen += len(w.hashes)
                if seen >= COUNT_WORDS:
                    yield from flush(found, cells, seen)
                    found, seen, cells = [], 0, None
        if seen:
            yield from flush(found, cells, seen)
        if per_lang:
            n = len(per_lang)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.zeros(n, np.int32)), pa.array(list(per_lang), pa.string()), pa.nulls(n, pa.binary()),
                pa.array(np.zeros(n, np.int64)), pa.array(list(per_lang.values()), pa.int64())], schema=schema)

    return run


def _pack(codes: np.ndarray, largest: int) -> list[np.ndarray]:
    """The columns of word codes as few sort keys, most telling first."""
    bits = max(1, int(largest).bit_length())
    per = max(1, min(DEPTH, 64 // bits))
    keys = []
    for i in range(0, DEPTH, per):
        key = np.zeros(codes.shape[1], np.uint64)
        for row in codes[i:i + per]:
            key = (key << U(bits)) | row.astype(np.uint64)
        keys.append(key)
    return keys


def _runs(keys: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """Starts of equal neighbours in the given order."""
    new = np.zeros(len(order), bool)
    new[0] = True
    for key in keys:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def _kept_words(frequent: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return _marked(frequent, (hashes >> U(64 - WORD_BITS)).astype(np.int64))


def _pair_cell(pair: np.ndarray) -> np.ndarray:
    return (pair & U((1 << PAIR_BITS) - 1)).astype(np.int64)


def _in_batches(flush, size: int):
    """Runs `flush(hashes, joined)` over the words of about `size` at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, seen = [], 0
        for batch in batches:
            for _, w in words_of(batch):
                parts.append((w.hashes, w.joined))
                seen += len(w.hashes)
                if seen >= size:
                    yield from flush(*(np.concatenate(p) for p in zip(*parts)))
                    parts, seen = [], 0
        if parts:
            yield from flush(*(np.concatenate(p) for p in zip(*parts)))

    return run


_BODIES = pa.schema([("grp", pa.int64()), ("body", pa.binary())])


def _count_pairs(frequent: np.ndarray, groups: int):
    """Pairs of frequent words of a batch, packed per group as half a hash and a count of at most 255."""
    def flush(hashes: np.ndarray, joined: np.ndarray):
        keep = _kept_words(frequent, hashes)
        at = np.flatnonzero(joined[:-1] & keep[:-1] & keep[1:])
        if not len(at):
            return
        pair = _fold(hashes[at], hashes[at + 1])
        # sorted by group, then by the lower half
        grp, half = (pair >> U(32)) % U(groups), pair & U(0xFFFFFFFF)
        once, count = np.unique((grp << U(32)) | half, return_counts=True)
        grp = (once >> U(32)).astype(np.int64)
        edge = np.append(np.flatnonzero(np.append(True, grp[1:] != grp[:-1])), len(grp))
        low, count = once.astype(np.uint32), np.minimum(count, 255).astype(np.uint8)
        pressed = zstandard.ZstdCompressor(level=1)
        bodies = []
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            # steps between sorted halves, by place of their bytes: the upper ones are mostly nought
            step = np.diff(low[a:b], prepend=np.uint32(0)).astype("<u4")
            planes = np.ascontiguousarray(step.view(np.uint8).reshape(-1, 4).T)
            bodies.append(pressed.compress(struct.pack("<I", b - a) + planes.tobytes() + count[a:b].tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(grp[edge[:-1]]), pa.array(bodies, pa.binary())], schema=_BODIES)

    return _in_batches(flush, DEAL_WORDS)


def _frequent_pairs(least: int):
    """Cells of the pairs of a group that occur `least` times at least; pairs that share half a hash add up, so none is missed."""
    def run(group: pa.Table) -> pa.Table:
        halves, counts = [], []
        for body in group.column("body").to_pylist():
            raw = zstandard.ZstdDecompressor().decompress(body)
            n = struct.unpack_from("<I", raw)[0]
            planes = np.frombuffer(raw, np.uint8, 4 * n, 4).reshape(4, n)
            halves.append(np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32))
            counts.append(np.frombuffer(raw, np.uint8, n, 4 + 4 * n))
        half, count = np.concatenate(halves), np.concatenate(counts)
        order = np.argsort(half, kind="stable")
        half, count = half[order], count[order].astype(np.int64)
        start = np.flatnonzero(np.append(True, half[1:] != half[:-1]))
        often = half[start][np.add.reduceat(count, start) >= min(least, 255)]
        return pa.table({"cell": pa.array(np.unique(_pair_cell(often.astype(np.uint64))), pa.int64())})

    return run


def _deal_suffixes(frequent: np.ndarray, pairs: np.ndarray, heavy: list[np.ndarray], groups: int):
    """Truncated suffixes of a batch, sorted, counted and packed per group."""
    def flush(hashes: np.ndarray, joined: np.ndarray):
        keep = _kept_words(frequent, hashes)
        on = np.zeros(len(hashes), bool)
        on[:-1] = joined[:-1] & keep[:-1] & keep[1:] & _marked(pairs, _pair_cell(_fold(hashes[:-1], hashes[1:])))
        at = np.flatnonzero(on)
        if not len(at):
            return
        once, inverse = np.unique(hashes[keep], return_inverse=True)
        code = np.zeros(len(hashes), np.int32)
        code[keep] = inverse + 1
        codes = np.zeros((DEPTH, len(at)), np.int32)
        codes[0] = code[at]
        alive, key, dealt, held = np.ones(len(at), bool), hashes[at], None, None
        for k in range(1, DEPTH):
            alive &= on[np.minimum(at + k - 1, len(on) - 1)]
            there = np.minimum(at + k, len(on) - 1)
            codes[k] = np.where(alive, code[there], 0)
            key = np.where(alive, _fold(key, hashes[there]), key)
            if k == 1:
                dealt, held = key.copy(), _marked(heavy[0], _cell(key))
            else:
                # a heavy prefix is split by one word more
                dealt = np.where(held & alive, key, dealt)
                if k < DEPTH - 1:
                    held &= alive & _marked(heavy[k - 1], _cell(key))
        grp = ((dealt >> U(8)) % U(groups)).astype(np.int64)
        del key, dealt, held, alive, inverse
        keys = [grp, *_pack(codes, len(once) + 1)]
        order = np.lexsort(keys[::-1])
        start = _runs(keys, order)
        count = np.diff(np.append(start, len(order))).astype(np.uint32)
        codes, grp = codes[:, order[start]], grp[order[start]]
        del keys, order
        edge = np.append(_runs([grp], np.arange(len(grp))), len(grp))
        pressed = zstandard.ZstdCompressor(level=3)
        bodies = []
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            own, local = np.unique(codes[:, a:b], return_inverse=True)
            if own[0] == 0:
                own, local = own[1:], local.reshape(DEPTH, -1)
            else:
                local = local.reshape(DEPTH, -1) + 1
            small = local.astype("<u2" if len(own) < 65536 else "<u4")
            bodies.append(pressed.compress(b"".join([
                struct.pack("<II", len(own), b - a), once[own - 1].astype("<u8").tobytes(), small.tobytes(), count[a:b].astype("<u4").tobytes()])))
        yield pa.RecordBatch.from_arrays([pa.array(grp[edge[:-1]]), pa.array(bodies, pa.binary())], schema=_BODIES)

    return _in_batches(flush, DEAL_WORDS)


def _unpack(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(body)
    own, n = struct.unpack_from("<II", raw)
    kind = np.dtype("<u2" if own < 65536 else "<u4")
    at = 8 + 8 * own
    end = at + DEPTH * n * kind.itemsize
    return (np.frombuffer(raw, "<u8", own, 8), np.frombuffer(raw, kind, DEPTH * n, at).reshape(DEPTH, n),
            np.frombuffer(raw, "<u4", n, end))


def _subtrees(heavy: list[np.ndarray], least: int):
    """Nodes of one group's subtrees with their leaf totals: those of `least` and more, and the parts of nodes split over groups."""
    def run(group: pa.Table) -> pa.Table:
        parts = [_unpack(b) for b in group.column("body").to_pylist()]
        once = np.unique(np.concatenate([p[0] for p in parts]))
        codes = np.concatenate([
            np.append(0, np.searchsorted(once, own) + 1).astype(np.int32)[local] for own, local, _ in parts], axis=1)
        count = np.concatenate([p[2] for p in parts]).astype(np.int64)
        order = np.lexsort(_pack(codes, len(once))[::-1])
        codes, count = codes[:, order], count[order]
        values = np.append(U(0), once)
        words, sizes, totals = [], [], []
        new = np.zeros(len(count), bool)
        new[0] = True
        new[1:] = codes[0, 1:] != codes[0, :-1]
        # before the sums of later depths: the hash of each row's prefix, and whether all prefixes so far are split
        key, held = values[codes[0]], np.ones(len(count), bool)
        for k in range(1, DEPTH):
            new[1:] |= codes[k, 1:] != codes[k, :-1]
            start = np.flatnonzero(new)
            total = np.add.reduceat(count, start)
            key = _fold(key, values[codes[k]])
            held = held & _marked(heavy[k - 1], _cell(key)) if k < DEPTH - 1 else np.zeros(len(count), bool)
            good = (codes[k][start] > 0) & ((total >= least) | held[start])
            words.append(values[codes[:k + 1, start[good]].T].ravel())
            sizes.append(np.full(good.sum(), k + 1))
            totals.append(total[good])
        ends = np.cumsum(np.append(0, np.concatenate(sizes)))
        return pa.table({
            "words": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(words).view(np.int64))),
            "n": pa.array(np.concatenate(totals), pa.int64())})

    return run


def phrase_counts(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words, phrases, langs): the words and phrases of up to five words with `least` occurrences and more.

    words: lang, word (bytes), h (64-bit hash of both); phrases: words (hashes),
    n; langs: lang, n (all word occurrences). Words and pairs below `least` can
    be in no phrase of that count, so they cut the suffixes; the bit tables that
    tell them apart have a fixed size, and where they err a rare pair stays and is
    counted like any other.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text_or_empty().alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(2 * work_partitions(spark), -(-size // (6 * GROUP_WORDS)))
    counted = staged(
        texts.mapInArrow(_count_words(1 / groups), "kind int, lang string, word binary, h long, n long")
        .groupBy("kind", "lang", "word", "h").agg(F.sum("n").alias("n")).where(F.col("n") >= F.when(F.col("kind") == 1, least).otherwise(0)))
    words, langs = counted.where("kind = 1"), counted.where("kind = 0").select("lang", "n")
    frequent = _bits(words.select(F.shiftrightunsigned("h", 64 - WORD_BITS).alias("cell")), WORD_BITS)
    total = langs.agg(F.sum("n")).first()[0] or 0
    heavy = [_bits(counted.where((F.col("kind") == k) & (F.col("n") > total / groups)).select(F.col("h").alias("cell")), CELL_BITS)
             for k in range(2, DEPTH)]
    often = texts.mapInArrow(_count_pairs(frequent, groups), "grp long, body binary").groupBy("grp").applyInArrow(
        _frequent_pairs(least), "cell long")
    pairs = _bits(staged(often), PAIR_BITS)
    suffixes = texts.mapInArrow(_deal_suffixes(frequent, pairs, heavy, groups), "grp long, body binary")
    nodes = suffixes.groupBy("grp").applyInArrow(_subtrees(heavy, least), "words array<long>, n long")
    phrases = nodes.groupBy("words").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    both = phrases.unionByName(words.select(F.array("h").alias("words"), "n"))
    return words.select("lang", "word", "h"), staged(both), langs


def _bits(cells: DataFrame, bits: int) -> np.ndarray:
    """A bit per cell; at most 2^(bits - 6) numbers reach the driver."""
    rows = cells.groupBy(F.shiftright("cell", 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(cell & 63 as int))")).alias("mask")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[rows["at"].to_numpy()] = rows["mask"].to_numpy().view(np.uint64)
    return out.astype("<u8").view(np.uint8)


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, absorb: int = 100) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `top` phrases of two to five words.

    A-Z are lower-cased, `.,;:!?` and line ends cut texts into pieces, spaces
    and tabs pieces into words. a: occurrences of the phrase in its language
    (at least `least`), n: all words; of the ways to cut the phrase into two, the
    one with the lowest score floor(1000 a n / (l r)) counts, l and r being the
    occurrences of its parts; ties go to the shorter first part. A phrase inside
    a longer one goes if absorb percent of its occurrences are the longer one's.
    It is enough to look one word further: whatever lies between the two is at
    least as frequent as the longer.

    A null language is `und`, null and empty texts have no words, texts of any length are
    counted whole, repeated rows each count; an empty table gives no rows and other
    columns are ignored. Equal scores and counts stand in byte order of the phrase.
    """
    words, counts, langs = phrase_counts(docs, least)
    k = F.size("words")
    found = counts.where(k > 1).select("words", F.col("n").alias("a"))
    tongue = words.select(F.col("h").alias("h0"), "lang").join(langs, "lang")
    part = counts.select("words", "n")
    cut = found.withColumn("h0", F.col("words")[0]).join(tongue, "h0").select(
        "words", "a", "lang", "n", F.explode(F.sequence(F.lit(1), k - 1)).alias("cut")).withColumn(
        "left", F.slice("words", F.lit(1), F.col("cut"))).withColumn("right", F.slice("words", F.col("cut") + 1, k - F.col("cut")))
    sides = cut.join(part.select(F.col("words").alias("left"), F.col("n").alias("l")), "left").join(
        part.select(F.col("words").alias("right"), F.col("n").alias("r")), "right")
    score = F.expr("(1000BD * cast(a as decimal(17,0)) * cast(n as decimal(17,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    best = sides.withColumn("score", score).groupBy("words", "a", "lang", "n").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("b")).select("words", "a", "lang", "n", "b.l", "b.r", "b.score")
    inner = found.where(k > 2).select(
        F.explode(F.array(F.slice("words", F.lit(1), k - 1), F.slice("words", F.lit(2), k - 1))).alias("words"), "a").groupBy("words").agg(
        F.max("a").alias("longer"))
    kept = best.join(inner, "words", "left").where(F.coalesce(100 * F.col("longer") < absorb * F.col("a"), F.lit(True)))
    order = [F.col("score").desc(), F.col("a").desc()]
    # ties at the end stay until the phrases themselves are compared
    near = staged(kept.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("place") <= top))
    spelt = near.select("words", F.posexplode("words").alias("no", "h")).join(
        words.select("h", F.col("word").cast("string").alias("word")), "h").groupBy("words").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("no", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    return near.join(spelt, "words").withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")).cast("long")).where(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
split as (
  select lang, [x for x in regexp_split_to_array(piece, '[ \t]+') if x <> ''] as w from pieces),
totals as (select lang, sum(len(w))::hugeint as n from split group by lang),
single as (select lang, w[i] as word from (select lang, w, unnest(generate_series(1, len(w))) as i from split)),
often as (select lang, word from single group by all having count(*) >= 100),
starts as (select lang, w, unnest(generate_series(1, len(w))) as i from split),
grams as (
  select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase
  from (select s.lang, w, i, unnest(generate_series(1, least(5, len(w) - i + 1))) as k from starts s
        join often o on o.lang = s.lang and o.word = w[i])),
f as (select lang, k, phrase, count(*) as c from grams group by all having count(*) >= 100),
cands as (select lang, k, phrase, c as a, string_split(phrase, ' ') as w from f where k > 1),
cuts as (select *, unnest(generate_series(1, k - 1)) as cut from cands),
scored as (
  select c.lang, c.k, c.phrase, c.a, c.w, c.cut, l.c as l, r.c as r, t.n,
         (1000::hugeint * c.a * t.n) // (l.c::hugeint * r.c) as score
  from cuts c join totals t on t.lang = c.lang
  join f l on l.lang = c.lang and l.phrase = array_to_string(c.w[1:c.cut], ' ')
  join f r on r.lang = c.lang and r.phrase = array_to_string(c.w[c.cut + 1:c.k], ' ')),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
inner_parts as (
  select lang, array_to_string(w[i:i + m - 1], ' ') as phrase, max(a) as longer
  from (select *, unnest(generate_series(1, k - m + 1)) as i from (select *, unnest(generate_series(2, k - 1)) as m from cands where k > 2))
  group by 1, 2),
kept as (
  select b.* from best b left join inner_parts p on p.lang = b.lang and p.phrase = b.phrase
  where p.longer is null or 100 * p.longer < 100 * b.a),
ranked as (
  select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score from kept)
select lang, rank, phrase, a, l, r, n::bigint as n, score::bigint as score from ranked where rank <= 2000
"""
