"""The registered queries of the training-data operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from martworks.llm import collocations, language, mixing, quality, toxicity
from martworks.llm.common import fold, table
from martworks.llm.bpe import encoded
from martworks.llm.embeddings import near_vectors
from martworks.llm.fingerprints import fingerprints
from martworks.llm.ngram_join import near_duplicates
from martworks.llm.packing import pack
from martworks.llm.quotes import as_mail, link_quotations
from martworks.llm.registry import ORACLES, QUERIES, query
from martworks.llm.repeats import remove_repeats
from martworks.llm.trie import rebuilt_trie

__all__ = ["ORACLES", "QUERIES"]


@query("op1_bm25_packing")
def op1(spark, sf_dir):
    """All documents in sequences of 2048 tokens, lexical neighbours together."""
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op2_ngram_join")
def op2(spark, sf_dir):
    """Links between documents that share four fifths of their five-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op7_projection_passes")
def op7(spark, sf_dir):
    """Links between vectors with a cosine of 0.95 and more."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query("op8_suffix_repeats")
def op8(spark, sf_dir):
    """Bytes covered by 50-byte strings of smaller documents, over all documents."""
    return remove_repeats(table(spark, sf_dir, "documents"))


def _scored(scores, held_out):
    return scores.withColumn("held_out", F.coalesce(held_out, F.lit(False)))


@query("op3_language")
def op3(spark, sf_dir):
    """Language of every document, learnt from the documents outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs, fold("doc_id", 5) != 0)
    return _scored(language.languages_of(docs, model), fold("doc_id", 5) == 0)


@query("op4_quality")
def op4(spark, sf_dir):
    """Quality of every document, learnt from labels outside the held-out quarter."""
    docs = table(spark, sf_dir, "documents")
    pair = quality.train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    return _scored(quality.quality_scores(docs, pair), fold("doc_id", 4) == 2)


@query("op5_toxicity")
def op5(spark, sf_dir):
    """Toxicity of every document, learnt from labels outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    pair = toxicity.train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return _scored(toxicity.toxic_scores(docs, pair), fold("doc_id", 5) == 0)


@query("op6_closed_syncmers")
def op6(spark, sf_dir):
    """Fingerprints of all documents and of their edited texts."""
    return fingerprints(table(spark, sf_dir, "documents"))


@query("op10_byte_bpe")
def op10(spark, sf_dir):
    """All documents encoded and decoded with the multilingual ranks."""
    return encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                   public_tokenizers.PATTERN)


@query("op9_quotation_links")
def op9(spark, sf_dir):
    """All conversations, written as mail with nested quotes, linked and freed of the quotes again."""
    return link_quotations(as_mail(table(spark, sf_dir, "conversations"))).withColumn(
        "text_sha256", F.sha2("text", 256)).drop("text")


@query("op11_prefix_trie")
def op11(spark, sf_dir):
    """Nodes and subtree totals of the prefix trie of all rebuilt conversations."""
    return rebuilt_trie(table(spark, sf_dir, "conversations"))


@query("op12_systematic_mix", mixing.SQL)
def op12(spark, sf_dir):
    """How often a mix of the sources, 3 : 1 : 2 in turn and half as large again, takes every document."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op13_collocations", collocations.SQL)
def op13(spark, sf_dir):
    """The 2000 strongest phrases of every language over all documents."""
    return collocations.collocations(table(spark, sf_dir, "documents"))
