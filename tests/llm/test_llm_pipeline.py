"""The pipeline's stages keep their contract on the smallest table."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

import corpus_pipeline
from martworks.llm import repeats

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
        after = {r.doc_id: r.text for r in docs.collect()}
        assert set(after) <= set(before)
        if i < 3:
            assert all(after[d] == before[d] for d in after)
        assert len(after) >= 0.6 * len(before), name
        before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == set(before)


def test_long_texts_come_in_short_batches(spark):
    """A batch is bounded by bytes, not only by rows: 10,000 long texts at once are more than a worker should hold."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        corpus_pipeline.cut_repeats(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
        texts = spark.range(0, 8000, 1, 1).select(F.repeat(F.lit("x"), 5000).alias("text"))
        rows = texts.mapInPandas(lambda frames: (pd.DataFrame({"n": [len(f)]}) for f in frames), "n long")
        assert max(r.n for r in rows.collect()) < 4000
    finally:
        spark.conf.set(name, before)


def test_anchors_hold_little_beside_the_text():
    """The arrays of a scan do not grow with the text handled at once (they took 60 bytes a byte before)."""
    rng = np.random.default_rng(1)
    parts = [rng.integers(97, 123, 5000, dtype=np.uint8).tobytes() for _ in range(400)]
    repeats.anchors(parts, 50, 20)
    tracemalloc.start()
    name, part, first, last, at, data = repeats.anchors(parts, 50, 20)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 * len(data)
    # every string lies in one run, and an anchor has the same name wherever the scan was cut
    assert (last - first + 1).sum() == sum(len(p) - 49 for p in parts)
    alone = [repeats.anchors([p], 50, 20)[0] for p in parts]
    assert np.array_equal(name, np.concatenate(alone))
