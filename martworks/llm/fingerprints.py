"""Closed-syncmer fingerprints, DataFrame functions only.

The letters of the alphabet are words: runs of non-space characters, cut every
16 characters. A run of K words is an anchor (closed syncmer) when the smallest
hashed inner run of S words stands at its start or its end. That depends on the
K words alone, so an unchanged passage keeps its anchors wherever it stands and
whatever is edited elsewhere. The fingerprint holds the SKETCH smallest anchor
hashes, 16 hex digits each, in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martworks.llm.common import text_or_empty
from martworks.operators.ranking import dense_ids

K = 5
S = 2
SKETCH = 64
WORD = r"\S{1,16}"
_NO_ID = -(1 << 63)


def with_anchors(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds `out`: array of (pos, hash), the closed syncmers of a text by word position.

    A text of fewer than K words has one anchor, all its words; one without words has none.
    """
    n = F.size("_h")
    words = F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0))
    last = K - S

    def anchor(i: Column) -> Column:
        edge = F.least(F.get("_p", i), F.get("_p", i + last))
        between = F.least(*(F.get("_p", i + j) for j in range(1, last)))
        return F.when(edge <= between, F.struct(
            i.alias("pos"), F.xxhash64(*(F.get("_h", i + j) for j in range(K))).alias("hash")))

    none = F.array().cast("array<struct<pos:int,hash:bigint>>")
    return (
        df.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))
        # hashes of S = 2 neighbouring words
        .withColumn("_p", F.zip_with(F.slice("_h", 1, F.greatest(n - 1, F.lit(0))), F.slice("_h", 2, F.greatest(n - 1, F.lit(0))),
                                     lambda a, b: F.xxhash64(a, b)))
        .withColumn(out, F.when(n >= K, F.array_compact(F.transform(F.sequence(F.lit(0), F.greatest(n - K, F.lit(0))), anchor)))
                    .when(n > 0, F.array(F.struct(F.lit(0).alias("pos"), F.xxhash64("_h").alias("hash")))).otherwise(none))
        .drop("_h", "_p")
    )


def with_sketch(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds `out`: the SKETCH smallest distinct anchor hashes in order."""
    return with_anchors(df, text, "_anchors").withColumn(
        out, F.slice(F.array_sort(F.array_distinct(F.col("_anchors.hash"))), 1, SKETCH)).drop("_anchors")


def likeness(a: str, b: str) -> Column:
    """Jaccard of the anchor sets, estimated from the smallest hashes of their union; 1 for two empty ones."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, SKETCH)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(a) + F.size(b) == 0, 1.0).otherwise(both / F.greatest(F.size(union), F.lit(1)))


def printed(sketch: str) -> Column:
    return F.array_join(F.transform(sketch, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last quarter (floor(n_chars / 4) code points)
    replaced by the first as many of the next document in ascending doc_id; the
    first follows the last. Null texts are empty; a null doc_id comes first;
    rows that share a doc_id are ordered by a hash of the text; rows that repeat
    exactly count as one document and get equal results. An empty table gives
    no rows. Places in the order come from a written, range-partitioned sort of
    the ids alone. Each document sends its predecessor no more text than that
    wants.
    """
    key = ["key", "row_key"]
    text = text_or_empty()
    plain = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("key"), F.xxhash64(text).alias("row_key"),
                        text.alias("text"))
    sizes = plain.select(*key, F.char_length("text").alias("n")).distinct()
    placed = dense_ids(sizes, key, "place")
    total = placed.count()
    after = placed.select((F.col("place") % max(1, total) + 1).alias("place"), F.col("key").alias("to_key"),
                          F.col("row_key").alias("to_row_key"), F.floor(F.col("n") / 4).cast("int").alias("want"))
    wanted = placed.join(after, "place").select(*key, "to_key", "to_row_key", "want")
    sketched = with_sketch(plain, "text", "sketch")
    sent = sketched.join(wanted, key).select(
        F.col("to_key").alias("key"), F.col("to_row_key").alias("row_key"), F.substring("text", F.lit(1), F.col("want")).alias("piece"),
        F.col("sketch").alias("next_sketch")).groupBy(*key).agg(
        F.first("piece").alias("piece"), F.first("next_sketch").alias("next_sketch"))
    n = F.char_length("text")
    edited = sketched.join(sent, key).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), n - F.floor(n / 4).cast("int")), "piece"))
    return with_sketch(edited, "edited", "edited_sketch").select(
        F.nullif("key", F.lit(_NO_ID)).alias("doc_id"), n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        printed("sketch").alias("fingerprint"), printed("edited_sketch").alias("edited_fingerprint"),
        likeness("sketch", "edited_sketch").alias("near_edited"), likeness("sketch", "next_sketch").alias("near_next"))
