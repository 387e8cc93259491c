"""The training-data operators against brute force on small fixtures, with nulls, empty texts, ties and repeated rows."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from martworks.llm import bpe, compression, embeddings, fingerprints, language, ngram_join, packing, quality, quotes, repeats, toxicity
from martworks.llm.bytesmath import shingles, words
from martworks.llm.common import components

RANKS_50K = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS_MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _texts() -> list[tuple]:
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    out = []
    for i in range(30):
        out.append((i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(30, 120)))))
    shared = " ".join(rng.choice(vocabulary) for _ in range(60))
    for i in range(30, 38):
        out.append((i, f"{out[i - 30][1]} {shared} tail {i}"))
    copy = out[5][1].split()
    for i in range(38, 44):
        edited = list(copy)
        edited[i - 30] = "changed"
        out.append((i, " ".join(edited)))
    # copies, nulls, empty, short, not ASCII, no spaces, long, a null id, a repeated row
    out += [(44, out[5][1]), (45, out[5][1]), (46, None), (47, ""), (48, "tiny"), (49, "Füße  ÉTÉ 日本語 ٣٤   x don't I'll  \n\n end 🙂"),
            (50, "ab" * 400), (51, "ab" * 300), (52, " ".join(rng.choice(vocabulary) for _ in range(4000))), (None, out[7][1]), (48, "tiny"),
            (53, " \t\n "), (54, "!!! ??? 123")]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    # extra columns whose names clash with inner ones
    return spark.createDataFrame(_texts(), "doc_id long, text string").select(
        "doc_id", "text", F.lit("en").alias("lang"), F.lit(7).alias("name"), F.lit(1).alias("n"), F.lit("k").alias("key"),
        F.lit(0).alias("row_key"), F.lit(0).alias("spans"), F.char_length("text").alias("n_chars")).repartition(5)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_repeats(docs, empty):
    got = {}
    for r in repeats.remove_repeats(docs).collect():
        got.setdefault(r.doc_id, []).append((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))
    seen: dict[bytes, int] = {}
    for doc, text in sorted((x for x in _texts() if x[0] is not None), key=lambda x: x[0]):
        data = (text or "").encode()
        cover, fresh = bytearray(len(data)), []
        for p in range(len(data) - 49):
            gram = data[p:p + 50]
            if gram in seen and seen[gram] < doc:
                cover[p:p + 50] = b"\1" * 50
            fresh.append(gram)
        for gram in fresh:
            seen.setdefault(gram, doc)
        kept = bytes(b for b, c in zip(data, cover) if not c)
        want = (len(data), sum(cover), len([x for x in bytes(cover).split(b"\0") if x]), hashlib.sha256(kept).hexdigest())
        assert set(got[doc]) == {want}
    assert got[None][0][1] == 0 and len(got[48]) == 2
    assert repeats.remove_repeats(empty).count() == 0


def test_repeats_cut_whole_code_points(spark):
    passage = "é" * 60
    rows = {r.doc_id: r.text for r in repeats.without_repeats(spark.createDataFrame(
        [(1, "a" + passage), (2, passage + "日"), (3, None)], "doc_id long, text string")).collect()}
    assert rows == {1: "a" + passage, 2: "日", 3: None}


def test_packing(docs, empty):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = packing.pack(docs, RANKS_50K, public_tokenizers.PATTERN, shard_tokens=4000).toPandas()
    left = [(d, tokenizer.encode(t or "", add_special_tokens=False).ids + [1]) for d, t in _texts()]
    for doc, own in pieces.sort_values("start").groupby("doc_id", dropna=False):
        mine = [ids for d, ids in left if d == doc or (d is None and doc != doc)]
        for start, length, crc in {(r.start, r.length, r.ids_crc32) for r in own.itertuples()}:
            assert any(zlib.crc32(np.array(ids[start:start + length], "<u4").tobytes()) == crc for ids in mine)
        assert own["length"].sum() == sum(map(len, mine))
    full = 0
    for _, own in pieces.sort_values("offset").groupby("sequence_id"):
        assert list(own["offset"]) == [0, *own["length"].cumsum()[:-1]] and own["length"].sum() <= 2048
        full += own["length"].sum() == 2048
    assert full >= pieces["length"].sum() // 2048 - 8
    assert packing.pack(empty, RANKS_50K, public_tokenizers.PATTERN).count() == 0


def test_bm25_scores():
    rng = np.random.default_rng(1)
    ids = [rng.integers(0, 40, n).astype(np.uint32) for n in (5, 30, 12, 40)]
    df = np.zeros(40, np.int64)
    for x in ids:
        df[np.unique(x)] += 1
    mean = np.mean([len(x) for x in ids])
    got = packing.Index(ids, df, 4, mean).scores(1)
    for j, other in enumerate(ids):
        want = 0.0
        for term in set(ids[1].tolist()):
            f = int((other == term).sum())
            idf = np.log1p((4 - df[term] + 0.5) / (df[term] + 0.5))
            want += idf * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(other) / mean)) if f else 0
        assert abs(got[j] - want) < 1e-9


def _linked_groups(sets: dict, threshold: float):
    links, up = {k: 0 for k in sets}, {k: k for k in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold:
                links[a] += 1
                links[b] += 1
                up[max(root(a), root(b))] = min(root(a), root(b))
    return links, {k: root(k) for k in sets}


def test_ngram_join(docs, empty):
    plain = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    got = {r.doc_id: r for r in ngram_join.near_duplicates(plain).collect()}
    sets = {d: set(shingles(words(t or ""), 5).tolist()) for d, t in _texts() if d is not None}
    links, group = _linked_groups(sets, 0.8)
    assert {d: (r.n_links, r.class_id) for d, r in got.items()} == {d: (links[d], group[d]) for d in sets}
    assert max(links.values()) >= 8
    assert ngram_join.near_duplicates(docs).count() == docs.count()
    assert ngram_join.near_duplicates(empty).count() == 0
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d in group if group[d] == d} | {None}


def test_small_blocks_lose_no_link(docs, monkeypatch):
    plain = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    whole = sorted(ngram_join.near_duplicates(plain).select("doc_id", "n_links", "class_id").collect())
    monkeypatch.setattr(ngram_join, "BLOCK", 150)
    assert sorted(ngram_join.near_duplicates(plain).select("doc_id", "n_links", "class_id").collect()) == whole


def test_near_vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(20, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(20 + i, (base[i % 3] + rng.normal(0, 0.05, 16)).tolist()) for i in range(40)]
    rows += [(60, base[0].tolist()), (61, (base[0] * 3).tolist()), (62, None), (63, [0.0] * 16), (64, [float("nan")] * 16), (65, [])]
    rows += [(66, [None] * 16), (67, [1e300] * 16), (68, [1e-300] * 16)]
    got = {r.vec_id: r for r in embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), window=4).collect()}
    unit = {i: np.array(v) / max(map(abs, v)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    unit = {i: v / np.linalg.norm(v) for i, v in unit.items()}
    for i, _ in rows:
        want = sum(1 for j in unit if j != i and i in unit and float(unit[i] @ unit[j]) >= 0.95)
        assert got[i].n_links == want
        assert got[i].kept == (got[i].component_id == i)
    assert got[62].component_id == 62 and got[68].component_id == 67
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embeddings.near_vectors(none).count() == 0


def test_components(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, 101), (101, 102), (7, 7), (200, 100)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in (100, 101, 102, 200)}}


def test_fingerprints(docs, empty):
    plain = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    got = {r.doc_id: r for r in fingerprints.fingerprints(plain).collect()}
    texts = {d: t or "" for d, t in _texts() if d is not None}
    order = sorted(texts)
    for i, doc in enumerate(order):
        text, after = texts[doc], texts[order[(i + 1) % len(order)]]
        n = len(text) // 4
        assert got[doc].n_chars == len(text)
        assert got[doc].edited_sha256 == hashlib.sha256((text[:len(text) - n] + after[:n]).encode()).hexdigest()
        assert 0 <= got[doc].near_edited <= 1
    assert got[5].fingerprint == got[44].fingerprint and got[44].near_next == 1.0
    assert got[10].near_edited > 0.3 and got[10].near_next < 0.1
    assert fingerprints.fingerprints(docs).count() == docs.count()
    assert fingerprints.fingerprints(empty).count() == 0


def test_closed_syncmers_by_hand(spark):
    text = " ".join(_texts()[3][1].split()[:40])
    frame = spark.createDataFrame([(text,)], "text string")
    got = fingerprints.with_anchors(frame, "text", "a").first().a
    tokens = spark.createDataFrame([(w,) for w in text.split()], "w string").select("w", F.xxhash64("w").alias("h")).collect()
    h = dict((r.w, r.h) for r in tokens)
    pairs = spark.createDataFrame([(i, h[a], h[b]) for i, (a, b) in enumerate(zip(text.split(), text.split()[1:]))], "i int, a long, b long")
    p = [r.p for r in pairs.select("i", F.xxhash64("a", "b").alias("p")).orderBy("i").collect()]
    want = [i for i in range(len(p) - 3) if min(p[i:i + 4]) in (p[i], p[i + 3])]
    assert [a.pos for a in got] == want


def test_bpe(docs, empty):
    with open(RANKS_MULTI, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = dict(_texts())
    for r in bpe.encoded(docs, RANKS_MULTI, public_tokenizers.PATTERN).collect():
        text = texts[r.doc_id] or ""
        ids = enc.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert bpe.encoded(empty, RANKS_MULTI, public_tokenizers.PATTERN).count() == 0


def test_classifiers_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    crc = lambda n: F.crc32(F.col("doc_id").cast("string").cast("binary")) % n
    model = language.train(docs, crc(5) != 0)
    got = language.languages_of(docs.where(crc(5) == 0), model).join(docs.select("doc_id", "lang"), "doc_id")
    assert got.where("lang_pred = lang").count() >= 0.95 * got.count()
    pair = quality.train(docs, labels, crc(4) != 2)
    held = quality.quality_scores(docs, pair).join(labels, "doc_id").where(crc(4) == 2)
    assert held.where("predicted = quality").count() >= 0.85 * held.count()
    toxic = toxicity.train(docs, labels, crc(5) != 0)
    held = toxicity.toxic_scores(docs, toxic).join(labels, "doc_id").where(crc(5) == 0)
    assert held.where("predicted = toxic").count() >= 0.85 * held.count()
    assert not model.predict(None)[2] and model.predict("123 !!")[0] == "und"
    for text in ("", " ", "x" * 300_000):
        assert 0 <= toxic.score(toxicity.features(toxic, text)) <= 1
        assert 0 <= pair.score(quality.features(pair, text)) <= 1


def test_classifiers_without_labels(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    learn = F.lit(True)
    pair = toxicity.train(docs, labels, learn)
    assert {r.predicted for r in toxicity.toxic_scores(docs, pair).collect()} == {0}
    assert quality.quality_scores(empty, quality.train(docs, labels, learn)).count() == 0
    model = language.train(empty, learn)
    assert language.languages_of(docs, model).count() == docs.count()
    assert toxicity.not_toxic(docs, pair).columns == docs.columns


def test_dictionary_contrast():
    own = [f"aa bb{i} wicked cc{i % 7}" for i in range(60)]
    other = [f"aa bb{i} gentle cc{i % 7}" for i in range(60)]
    body = compression.contrast(own, other, 200)
    assert b"wicked" in body and b"gentle" not in body


def test_quotations(spark):
    mails = [(1, 0, "a", "Hello there\nhow are you"), (1, 1, "b", "> Hello  there\n> how are YOU\nfine\n\nthanks"),
             (1, 2, "a", ">> Hello there\n>> how are you\n> fine\n> \n> thanks\ngood"), (2, 0, "c", "> unknown words\nwhat?"),
             (2, 1, "d", "> good\nindeed"), (3, 0, None, None), (None, 0, "e", "> good\nno thread"), (1, 0, "a", "Hello there\nhow are you")]
    frame = spark.createDataFrame(mails, "thread long, place long, role string, text string")
    got = {(r.thread, r.place): r for r in quotes.link_quotations(frame).collect()}
    assert len(got) == 7
    assert (got[1, 1].reply_thread, got[1, 1].reply_place) == (1, 0)
    assert (got[1, 2].reply_thread, got[1, 2].reply_place) == (1, 1)
    assert (got[2, 1].reply_thread, got[2, 1].reply_place) == (None, None) or got[2, 1].reply_thread == 1
    assert got[2, 0].n_quoted == 1 and got[2, 0].n_linked == 0 and got[2, 0].text == "what?"
    assert got[1, 2].text == "good" and got[1, 1].text == "fine\n\nthanks"
    assert (got[1, 2].root_thread, got[1, 2].root_place) == (1, 0)
    assert got[3, 0].text == "" and got[None, 0].reply_thread is None or got[None, 0].text == "no thread"


def test_quotes_of_conversations_come_off_again(spark):
    talks = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    got = {(r.thread, r.place): r for r in quotes.link_quotations(quotes.as_mail(talks)).collect()}
    turns = {(r.conv_id, r.turn): r.text or "" for r in talks.collect()}
    assert {k: r.text for k, r in got.items()} == turns
    for (conv, turn), r in got.items():
        before = sorted(t for c, t in turns if c == conv and t < turn)
        if before and turns[conv, before[-1]].strip():
            assert r.n_linked >= 1 and r.reply_thread == conv
