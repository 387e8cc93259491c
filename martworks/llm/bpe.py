"""Byte-level BPE with higher-order functions: ranked merges are folded over the bytes of a word.

A word is its bytes as hex pairs. The fold holds the pieces and the rank of each
neighbouring pair; every step merges the leftmost pair of the lowest rank and
looks up the two pairs that the merge made. Ranks come from a literal map, dealt
to small maps by crc32 because Spark searches a map from its first key. Words
that are frequent in a bounded sample are folded once and put into such a map
too, with the beginnings and ends that tokens cut from them. Any other word is
cut in two known pieces if two tokens that meet there were neighbours in a folded
word, and is folded where it stands if there is no such cut. Decoding joins the
bytes of the ids.

The cut is exact. Merges inside two neighbouring tokens depend on no others as
long as no merge crosses their border, and the first to cross it in a word would
cross it in the two tokens alone. So tokens of which all neighbours are
neighbours in some fold are the fold of their bytes, and results do not depend on
the sample.
"""

from __future__ import annotations

import base64
import json
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from martworks.llm.common import ready, staged, text_or_empty

RANK_MAPS = 1 << 14
# bounds of the sample and of the words folded ahead
SAMPLE_DOCS = 20_000
FOLDED_WORDS = 200_000
# bounds of what the map of known pieces holds, and of the neighbours
FREQUENT_WORDS, BEGINNINGS, ENDS = 90_000, 20_000, 40_000
NEIGHBOURS = 100_000
# lengths of the end at which a word is cut, likeliest first
CUTS = (4, 5, 3, 6, 7, 2, 8)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def _dealt(entries: dict[str, object], maps: int, value: str) -> Column:
    """A literal array of maps; an entry is in map number crc32(key) mod `maps`."""
    out: list[dict] = [{} for _ in range(maps)]
    for key, v in entries.items():
        out[zlib.crc32(key.encode()) % maps][key] = v
    return F.from_json(F.lit(json.dumps(out, ensure_ascii=False, separators=(",", ":"))), f"array<map<string,{value}>>")


def _found(dealt: Column, maps: int, key: Column) -> Column:
    return F.try_element_at(F.get(dealt, (F.crc32(key.cast("binary")) % maps).cast("int")), key)


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold_word(word: Column, rank) -> Column:
    """Ids of a word as text, joined by commas. rank(piece as hex) -> Column."""
    pairs = lambda parts: F.zip_with(
        F.slice(parts, F.lit(1), F.size(parts) - 1), F.slice(parts, F.lit(2), F.size(parts) - 1), lambda a, b: rank(F.concat(a, b)))

    def merged(state: Column, at: Column) -> Column:
        parts, ranks = state["parts"], state["ranks"]
        i = at.cast("int")
        n = F.size(parts)
        new = F.concat(F.get(parts, i - 1), F.get(parts, i))
        before = F.when(i > 1, F.array(rank(F.concat(F.get(parts, i - 2), new)))).otherwise(F.array().cast("array<int>"))
        after = F.when(i < n - 1, F.array(rank(F.concat(new, F.get(parts, i + 1))))).otherwise(F.array().cast("array<int>"))
        return F.struct(
            F.concat(F.slice(parts, F.lit(1), i - 1), F.array(new), F.slice(parts, i + 2, n)).alias("parts"),
            F.concat(F.slice(ranks, F.lit(1), F.greatest(i - 2, F.lit(0))), before, after, F.slice(ranks, i + 2, n)).alias("ranks"))

    def step(state: Column, _: Column) -> Column:
        low = F.array_min(state["ranks"])
        return F.when(low.isNull(), state).otherwise(_let(F.array_position(state["ranks"], low), lambda at: merged(state, at)))

    def folded(code: Column) -> Column:
        size = (F.length(code) / 2).cast("int")
        parts = F.transform(F.sequence(F.lit(1), size), lambda i: F.substring(code, i * 2 - 1, F.lit(2)))
        start = _let(parts, lambda p: F.struct(p.alias("parts"), F.when(size > 1, pairs(p)).otherwise(
            F.array().cast("array<int>")).alias("ranks")))
        return F.aggregate(F.sequence(F.lit(1), size), start, step, lambda s: F.array_join(
            F.transform(s["parts"], lambda x: rank(x).cast("string")), ","))

    return _let(F.hex(word), lambda code: F.coalesce(rank(code).cast("string"), folded(code)))


@dataclass
class Known:
    """Ids of known words and pieces as text, and for a token those that follow it in a fold."""

    ids: dict[str, str]
    after: dict[int, list[int]]

    def neighbours(self) -> Column:
        """`after` as a literal array of arrays, by token."""
        rows = [self.after.get(i, []) for i in range(max(self.after, default=0) + 1)]
        return F.from_json(F.lit(json.dumps(rows, separators=(",", ":"))), "array<array<int>>")


class Coder:
    """Encoding and decoding expressions for one rank file and split pattern."""

    def __init__(self, ranks_path: str, pattern: str):
        ranks = read_ranks(ranks_path)
        by_hex = {k.hex().upper(): v for k, v in ranks.items()}
        self.dealt = _dealt(by_hex, RANK_MAPS, "int")
        pieces = [""] * (max(ranks.values()) + 1)
        for k, v in by_hex.items():
            pieces[v] = k
        self.pieces = F.split(F.lit(" ".join(pieces)), " ")
        # \\s as in Unicode
        self.pattern = "(?U)" + pattern

    def with_ranks(self, body) -> Column:
        """body(rank) with rank(piece) -> Column; the literal stands in the plan once, bound to a lambda variable."""
        return _let(self.dealt, lambda dealt: body(lambda piece: _found(dealt, RANK_MAPS, piece)))

    def words(self, text: Column) -> Column:
        return F.regexp_extract_all(text, F.lit(self.pattern), F.lit(0))

    def frequent(self, docs: DataFrame) -> Known:
        """Words that are most frequent in a bounded sample of documents, and what is known from folding them."""
        chosen = docs.select(F.xxhash64("doc_id").alias("place"), "doc_id").orderBy("place").limit(SAMPLE_DOCS).select("doc_id").distinct()
        # ids of a bounded number of documents
        part = docs.join(F.broadcast(chosen), "doc_id")
        words = part.select(F.explode(self.words(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
        top = staged(words.where(F.length("word") <= 64).orderBy(F.desc("n"), "word").limit(FOLDED_WORDS))
        folded = staged(top.repartition(24).select(
            "word", "n", self.with_ranks(lambda rank: fold_word(F.col("word"), rank)).alias("ids")))
        tokens = folded.select(F.split("ids", ",").alias("t")).where(F.size("t") > 1)
        # tokens before and after every border
        cut = tokens.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("t") - 1), lambda i: F.struct(
            F.slice("t", F.lit(1), i).alias("left"), F.slice("t", i + 1, F.size("t")).alias("right")))).alias("c"))

        def pieces(side: str, most: int) -> DataFrame:
            best = cut.groupBy(F.col(f"c.{side}").alias("t")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "t").limit(most)
            # a border inside a character cuts no text
            return best.select(self.decode(F.col("t")).cast("string").alias("word"), F.array_join("t", ",").alias("ids")).where(
                F.is_valid_utf8("word"))

        own = folded.where("n > 1").orderBy(F.desc("n"), "word").limit(FREQUENT_WORDS).select("word", "ids")
        # a word of the vocabulary is its one id, whatever the merges make of it, so words win over pieces
        known = {}
        for rows in (pieces("left", BEGINNINGS), pieces("right", ENDS), own):
            known.update((r["word"], r["ids"]) for r in rows.toLocalIterator())
        pairs = cut.select(F.element_at("c.left", -1).cast("int").alias("a"), F.element_at("c.right", 1).cast("int").alias("b"))
        after: dict[int, list[int]] = {}
        for r in pairs.groupBy("a", "b").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "a", "b").limit(NEIGHBOURS).toLocalIterator():
            after.setdefault(r["a"], []).append(r["b"])
        return Known(known, after)

    def encode(self, text: Column, frequent: Known) -> Column:
        """Ids of a text as text, joined by commas."""
        maps = max(1, len(frequent.ids) // 3)
        known, after = _dealt(frequent.ids, maps, "string"), frequent.neighbours()

        def cut(word: Column, size: int, k: Column, pairs: Column) -> Column:
            met = lambda l, r: F.array_contains(
                F.get(pairs, F.substring_index(l, ",", -1).cast("int")), F.substring_index(r, ",", 1).cast("int"))
            return F.when(F.length(word) > size, _let(_found(k, maps, F.substring(word, -size, size)), lambda r: F.when(
                r.isNotNull(), _let(_found(k, maps, F.substring(word, F.lit(1), F.length(word) - size)), lambda l: F.when(
                    met(l, r), F.concat(l, F.lit(","), r))))))

        def ids(word: Column, rank, k: Column, pairs: Column) -> Column:
            return F.coalesce(_found(k, maps, word), rank(F.hex(word)).cast("string"),
                              *[cut(word, size, k, pairs) for size in CUTS], fold_word(word, rank))

        return F.array_join(self.with_ranks(lambda rank: _let(known, lambda k: _let(after, lambda pairs: F.transform(
            self.words(text), lambda w: ids(w, rank, k, pairs))))), ",")

    def decode(self, ids: Column) -> Column:
        """Bytes of an array of ids given as text."""
        return F.unhex(F.array_join(_let(self.pieces, lambda p: F.transform(ids, lambda i: F.get(p, i.cast("int")))), ""))


def encoded(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Each match of the pattern is encoded separately, without special tokens. A
    null or empty text has no tokens. Rows are handled one by one, so repeated
    rows and null ids pass through; other columns are ignored.
    """
    ready(docs.sparkSession)
    coder = Coder(ranks_path, pattern)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    ids = F.filter(F.split("joined", ","), lambda x: x != "")
    return plain.withColumn("joined", coder.encode(F.col("text"), coder.frequent(plain))).withColumn("ids", ids).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2("joined", 256).alias("ids_sha256"),
        F.sha2(coder.decode(F.col("ids")), 256).alias("decoded_sha256"))
