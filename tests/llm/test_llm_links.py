"""Similarity joins on awkward inputs: vectors that lean one way, many short texts, quotes of several levels."""

import numpy as np
import pytest

from martworks.llm import embeddings, links, ngram_join, quotes
from martworks.llm.bytesmath import shingles, words


def leaning(rng, rows, dim, mean_cosine):
    common = rng.normal(size=dim)
    common /= np.linalg.norm(common)
    own = rng.normal(size=(rows, dim))
    own /= np.linalg.norm(own, axis=1)[:, None]
    out = np.sqrt(mean_cosine) * common + np.sqrt(1 - mean_cosine) * own
    return out / np.linalg.norm(out, axis=1)[:, None]


def beside(rng, vectors, low, high):
    """A vector for each at a cosine drawn from [low, high]."""
    turn = rng.normal(size=vectors.shape)
    turn -= (turn * vectors).sum(axis=1)[:, None] * vectors
    turn /= np.linalg.norm(turn, axis=1)[:, None]
    c = rng.uniform(low, high, len(vectors))[:, None]
    return c * vectors + np.sqrt(1 - c * c) * turn


def components_of(linked):
    low = list(range(len(linked)))
    for i in range(len(linked)):
        todo = [i] if low[i] == i else []
        while todo:
            at = todo.pop()
            for j in np.flatnonzero(linked[at]):
                if low[j] > i:
                    low[j] = i
                    todo.append(j)
    return low


@pytest.mark.parametrize("mean_cosine", [0.0, 0.85])
def test_recall_of_near_vectors(spark, mean_cosine):
    rng = np.random.default_rng(5)
    base = leaning(rng, 4000, 64, mean_cosine)
    vectors = np.concatenate([base, beside(rng, base[:400], 0.9505, 0.965)])
    linked = vectors @ vectors.T >= 0.95
    np.fill_diagonal(linked, False)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embeddings.near_vectors(frame).collect()}
    want = linked.sum(axis=1)
    assert all(got[i].n_links <= want[i] for i in got)
    assert sum(r.n_links for r in got.values()) >= 0.98 * want.sum() >= 0.98 * 800
    low = components_of(linked)
    same = [got[i].component_id == low[i] for i in got]
    assert np.mean([s for i, s in enumerate(same) if want[i]]) >= 0.98
    assert all(got[i].component_id == i for i in got if not want[i])


def test_codes_bound_the_rounding():
    rng = np.random.default_rng(6)
    unit = rng.normal(size=(500, 48)) * rng.choice([1e-6, 1.0], size=(500, 48))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    near, off = embeddings.decoded(embeddings.codes(unit))
    assert (np.linalg.norm(near - unit, axis=1) <= off).all()
    slack = off[:, None] + off[None] + off[:, None] * off[None]
    assert (np.abs(near @ near.T - unit @ unit.T) <= slack).all()


def test_connected_parts_of_a_matrix():
    rng = np.random.default_rng(7)
    for density in (0.0, 0.01, 0.03, 1.0):
        linked = rng.random((40, 60)) < density
        whole = np.zeros((100, 100), bool)
        whole[:40, 40:] = linked
        low = components_of(whole | whole.T)
        parts = links.joined(linked)
        assert sorted(r for rows, _ in parts for r in rows) == list(np.flatnonzero(linked.any(axis=1)))
        for rows, columns in parts:
            assert len({low[r] for r in rows} | {low[40 + c] for c in columns}) == 1
            assert set(np.flatnonzero(np.array(low[:40]) == low[rows[0]])) == set(rows)


def test_bands_reach_the_recall():
    assert ngram_join.bands_and_rows(0.8, 0.9999) == (24, 5)
    for threshold in (0.02, 0.3, 0.5, 0.8, 0.95):
        bands, rows = ngram_join.bands_and_rows(threshold, 0.999)
        assert 1 - (1 - threshold ** rows) ** bands >= 0.999
    assert ngram_join.bands_and_rows(1.0, 0.999) == (1, 12)


def test_many_short_near_copies(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 50)
    # texts differ in their last or first word: each is linked to those that differ at the same end
    body = " ".join(f"w{i}" for i in range(30))
    texts = [f"{body} x{i}" for i in range(120)] + [f"y{i} {body}" for i in range(80)] + ["alone in here with other words"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [set(shingles(words(t), 5).tolist()) for t in texts]
    linked = np.array([[i != j and len(a & b) / len(a | b) >= 0.8 for j, b in enumerate(sets)] for i, a in enumerate(sets)])
    low = components_of(linked)
    got = {r.doc_id: (r.n_links, r.class_id) for r in ngram_join.near_duplicates(frame).collect()}
    assert got == {i: (linked[i].sum(), low[i]) for i in range(len(texts))}


def test_quotes_by_paragraph_and_level(spark):
    mails = [(1, 0, "a", "first part\nof two lines\n\nsecond part"),
             (1, 1, "b", "> second part\nonly the second"),
             (1, 2, "a", "> > first part\n> > of two lines\n> >\n> > second part\n> only the second\nfine"),
             (2, 0, "c", ">> only the second\nfrom afar"),
             (2, 1, "d", "> nobody wrote this\n>> second part\n\n\nlast")]
    frame = spark.createDataFrame(mails, "thread long, place long, role string, text string")
    got = {(r.thread, r.place): r for r in quotes.link_quotations(frame).collect()}
    level = lambda r: [tuple(x) for x in r.levels]
    assert (got[1, 1].reply_thread, got[1, 1].reply_place, level(got[1, 1])) == (1, 0, [(1, 1, 1)])
    assert (got[1, 2].reply_thread, got[1, 2].reply_place, level(got[1, 2])) == (1, 1, [(1, 1, 1), (2, 2, 2)])
    assert (got[1, 2].n_quoted, got[1, 2].n_linked, got[1, 2].text) == (3, 3, "fine")
    # its place is before that of the message quoted
    assert (got[2, 0].n_quoted, got[2, 0].n_linked, got[2, 0].reply_place) == (1, 0, None)
    assert (got[2, 1].reply_thread, got[2, 1].reply_place, level(got[2, 1])) == (1, 0, [(1, 1, 0), (2, 1, 1)])
    assert got[2, 1].text == "last" and got[1, 0].text == mails[0][3] and level(got[1, 0]) == []


def test_quotes_of_no_messages(spark):
    none = spark.createDataFrame([], "thread long, place long, role string, text string, levels string, hash string")
    assert quotes.link_quotations(none).count() == 0
