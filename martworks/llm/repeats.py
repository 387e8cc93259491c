"""Repeated passages by sparse suffix sorting: anchored suffixes are sorted outside memory, the rest is induced.

A string of `width` bytes always holds the same anchor: its smallest-hashed
sub-string of `seed` bytes. So suffix tuples are kept for anchors only (about
6 % of all positions) and every other suffix follows from them:

0. Exact copies of a text with a smaller doc_id are covered whole and take no
   further part.
1. Anchors are named by hash and dealt by name; names found in one document
   only drop out. (Positions of a name that repeats inside one batch are known
   at once, so a hot passage travels once per batch, not once per document.)
2. The remaining suffix tuples (name, bytes before and after the anchor,
   document) go through Spark's sort, which spills runs to disk and merges
   them through a queue. Within a name the tuples are put in suffix order with
   their common-prefix values, once for the text after the anchor and once,
   read backwards, for the text before it.
3. A string that starts o bytes before the anchor is induced from both orders:
   two are equal if and only if the values reach width - o after and o before
   it. No hash decides here, bytes do. The smallest document of each class
   covers the others.
4. The covered ranges return to their documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from martworks.llm.bytesmath import U, prefix, slide_min, windows
from martworks.llm.common import ready, staged, text_or_empty

WIDTH = 50
SEED = 20
# bytes of text handled at once inside a task
PIECE = 2_000_000
# starts of strings whose hashes are held at once
SCAN = 1 << 18
# suffix tuples brought into suffix order at once; a name is never cut
SORT_ROWS = 60_000
_POSITION = U((1 << 22) - 1)


def _pieces(data: bytes, width: int) -> Iterator[tuple[int, bytes]]:
    """A text in pieces that overlap so that every string of `width` bytes lies whole in exactly one."""
    for at in range(0, max(1, len(data) - width + 1), PIECE):
        yield at, data[at:at + PIECE + width - 1]


def _batches(frames: Iterator[pd.DataFrame], width: int) -> Iterator[tuple[pd.DataFrame, list]]:
    """Groups of (row, offset in the text, bytes) of about PIECE bytes."""
    for frame in frames:
        group, size = [], 0
        for row, text in enumerate(frame["text"]):
            for at, part in _pieces(text.encode("utf-8", "replace"), width):
                if len(part) < width:
                    continue
                group.append((row, at, part))
                size += len(part)
                if size >= PIECE:
                    yield frame, group
                    group, size = [], 0
        if group:
            yield frame, group


def anchors(parts: list[bytes], width: int, seed: int) -> tuple[np.ndarray, ...]:
    """Runs of strings with one anchor: name, part, first and last start, anchor position (all within `data`).

    The starts are scanned SCAN at a time, so the arrays of a scan stay small however much text is handled at once.
    """
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    runs, before, begun = [], [], (-1, -1, -1)
    for low in range(0, len(data) - width + 1, SCAN):
        names = windows(prefix(data[low:low + SCAN + width - 1]), seed)
        key = (names & ~_POSITION) | np.arange(low, low + len(names), dtype=np.uint64)
        at = (slide_min(key, width - seed + 1) & _POSITION).astype(np.int64)
        start = np.arange(low, low + len(at))
        own = np.searchsorted(ends, start, side="right")
        whole = start + width <= ends[own]
        at, own, start = (np.append(b, x[whole]) for b, x in zip(begun, (at, own, start)))
        first = np.flatnonzero((at[1:] != at[:-1]) | (own[1:] != own[:-1])) + 1
        runs.append((names[at[first] - low], own[first], start[first], at[first]))
        before.append(start[first - 1])
        begun = at[-1], own[-1], start[-1]
    name, own, first, at = (np.concatenate(x) for x in zip(*runs))
    return name, own, first, np.append(np.concatenate(before)[1:], begun[2]), at, data


def _name_rows(width: int, seed: int):
    """Stage 1, in the documents' tasks: (name, doc, row key, anchor), or known anchors of a document."""
    def run(frames):
        for frame, group in _batches(frames, width):
            name, part, _, _, at, _ = anchors([g[2] for g in group], width, seed)
            begin = np.cumsum([0, *(len(g[2]) for g in group)])[:-1]
            rows = np.array([g[0] for g in group])
            offset = np.array([g[1] for g in group])
            doc, key = frame["doc_id"].to_numpy(np.int64), frame["row_key"].to_numpy(np.int64)
            pos = at - begin[part] + offset[part]
            row = rows[part]
            order = np.argsort(name)
            name, row, pos = name[order], row[order], pos[order]
            head = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
            size = np.diff(np.append(head, len(name)))
            low = np.minimum.reduceat(doc[row], head)
            lone = low == np.maximum.reduceat(doc[row], head)
            asks = np.repeat(lone, size)
            # in the order of the text again: neighbours share document and key, which packs well
            ask = np.flatnonzero(asks)[np.argsort(order[asks], kind="stable")]
            yield pd.DataFrame({
                "name": np.concatenate([name[ask], name[head[~lone]]]).view(np.int64),
                "doc_id": np.concatenate([doc[row[ask]], low[~lone]]),
                "row_key": np.concatenate([key[row[ask]], np.zeros((~lone).sum(), np.int64)]),
                # -1: known to be in two documents, no answer wanted
                "pos": np.concatenate([pos[ask], np.full((~lone).sum(), -1)]), "known": None})
            if (~asks).any():
                known = pd.DataFrame({"row": row[~asks], "pos": pos[~asks]})
                packed = known.groupby("row")["pos"].agg(lambda p: np.sort(p.to_numpy()).astype("<i8").tobytes())
                yield pd.DataFrame({
                    "name": key[packed.index], "doc_id": doc[packed.index], "row_key": key[packed.index], "pos": -2,
                    "known": packed.to_numpy()})
    return run


_NAMES = "name long, doc_id long, row_key long, pos long, known binary"


def _shared(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Stage 1, dealt and sorted by name: the anchors whose name two documents hold."""
    rest: pd.DataFrame | None = None

    def shared(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        name, doc = frame["name"].to_numpy(), frame["doc_id"].to_numpy()
        head = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
        told = np.logical_or.reduceat(frame["pos"].to_numpy() == -1, head)
        return (np.minimum.reduceat(doc, head) != np.maximum.reduceat(doc, head)) | told, np.diff(np.append(head, len(name)))

    def settle(frame: pd.DataFrame) -> pd.DataFrame:
        out = frame[np.repeat(*shared(frame)) & (frame["pos"].to_numpy() >= 0)]
        return pd.DataFrame({"doc_id": out["doc_id"], "row_key": out["row_key"],
                             "known": [x.tobytes() for x in out["pos"].to_numpy().astype("<i8")]})

    for frame in frames:
        told = (frame["pos"] == -2).to_numpy()
        if told.any():
            yield frame.loc[told, ["doc_id", "row_key", "known"]]
            frame = frame[~told]
        if not len(frame):
            continue
        rest = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        name = rest["name"].to_numpy()
        cut = int(np.searchsorted(name, name[-1]))
        if cut:
            yield settle(rest.iloc[:cut])
            rest = rest.iloc[cut:]
        # the positions of one document wait for a second one; after that a mark is enough
        if len(rest) > SORT_ROWS and shared(rest)[0][0]:
            yield settle(rest)
            rest = rest.iloc[:1].assign(pos=-1)
    if rest is not None and len(rest):
        yield settle(rest)


def _suffix_rows(width: int, seed: int):
    """Stage 2, in the documents' tasks: one suffix tuple per different surrounding of a shared anchor, and ranges
    that a smaller document of the same batch already covers."""
    def run(frames):
        for frame, group in _batches(frames, width):
            name, part, first, last, at, data = anchors([g[2] for g in group], width, seed)
            begin = np.cumsum([0, *(len(g[2]) for g in group)])[:-1]
            offset = np.array([g[1] for g in group])
            row = np.array([g[0] for g in group])[part]
            doc, key = frame["doc_id"].to_numpy(np.int64), frame["row_key"].to_numpy(np.int64)
            pos = at - begin[part] + offset[part]
            keep = np.zeros(len(at), bool)
            for r in np.unique(row):
                told = frame["known"].iloc[r]
                if told is not None and len(told):
                    own = slice(*np.searchsorted(row, [r, r + 1]))
                    keep[own] = np.isin(pos[own], np.frombuffer(told, "<i8"))
            if not keep.any():
                continue
            name, row, first, last, at, pos = (x[keep] for x in (name, row, first, last, at, pos))
            shift = pos - at
            blob = data.tobytes()
            text = np.array([blob[a:b + width] for a, b in zip(first, last)], object)
            lead = at - first
            order = np.lexsort((doc[row], lead, name))
            seen: dict[tuple, int] = {}
            owner = np.zeros(len(order), bool)
            for o in order:
                k = (name[o], lead[o], text[o])
                if k not in seen:
                    seen[k] = doc[row[o]]
                    owner[o] = True
                elif seen[k] == doc[row[o]]:
                    owner[o] = True
            yield pd.DataFrame({
                "name": name[owner].view(np.int64), "doc_id": doc[row[owner]], "row_key": key[row[owner]],
                "start": (first + shift)[owner], "lead": lead[owner].astype(np.int32), "body": text[owner]})
            rest = ~owner
            if rest.any():
                yield pd.DataFrame({
                    "name": 0, "doc_id": doc[row[rest]], "row_key": key[row[rest]], "start": (first + shift)[rest],
                    "lead": -(last - first + 1)[rest].astype(np.int32), "body": None})
    return run


_SUFFIXES = "name long, doc_id long, row_key long, start long, lead int, body binary"


def _classes(text: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix order of the rows of a byte matrix within their groups, with common-prefix values of neighbours (-1 at a
    group's start)."""
    n, width = text.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = text
    columns = padded.view(">u8").astype(np.uint64)
    order = np.lexsort((*columns.T[::-1], group))
    a, b = text[order[1:]], text[order[:-1]]
    differ = a != b
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    common[group[order[1:]] != group[order[:-1]]] = -1
    return order, np.concatenate([[-1], common])


def induce(name: np.ndarray, doc: np.ndarray, lead: np.ndarray, body: list[bytes], width: int) -> np.ndarray:
    """For every tuple and every start o bytes before the anchor: does a smaller document hold the same string?

    Returns a boolean matrix (tuple, o); strings that a tuple does not hold are False.
    """
    n, most = len(name), int(lead.max()) + 1
    group = np.cumsum(np.concatenate([[True], name[1:] != name[:-1]]))
    before, after = np.zeros((n, most), np.uint8), np.zeros((n, width), np.uint8)
    fill = np.array([len(b) for b in body])
    flat, begin = np.frombuffer(b"".join(body), np.uint8), np.cumsum([0, *fill[:-1]])
    for o in range(1, most):
        has = lead >= o
        before[has, o - 1] = flat[(begin + lead - o)[has]]
    for o in range(width):
        has = lead + o < fill
        after[has, o] = flat[(begin + lead + o)[has]]
    (right, right_common), (left, left_common) = _classes(after, group), _classes(before, group)
    covered = np.zeros((n, most), bool)
    for o in range(most):
        # first start in the body: 0, so o = lead; last: fill - width
        valid = np.flatnonzero((lead >= o) & (lead - o + width <= fill))
        if not len(valid):
            continue
        cr, cl = np.empty(n, np.int64), np.empty(n, np.int64)
        cr[right] = np.cumsum(right_common < width - o)
        cl[left] = np.cumsum(left_common < o)
        both = cr[valid] * (n + 1) + cl[valid]
        order = np.lexsort((doc[valid], both))
        both = both[order]
        head = np.concatenate([[True], both[1:] != both[:-1]])
        low = doc[valid][order][np.flatnonzero(head)][np.cumsum(head) - 1]
        covered[valid[order], o] = low < doc[valid][order]
    return covered


def _ranges(frame: pd.DataFrame, width: int) -> pd.DataFrame:
    """Covered ranges of starts (row key, start, count) of a sorted run of whole names."""
    lead = frame["lead"].to_numpy(np.int64)
    covered = induce(frame["name"].to_numpy(), frame["doc_id"].to_numpy(), lead, list(frame["body"]), width)
    row, o = np.nonzero(covered)
    if not len(row):
        return pd.DataFrame({"doc_id": [], "row_key": [], "start": [], "count": []}).astype("int64")
    start = frame["start"].to_numpy()[row] + lead[row] - o
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    head = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)]))
    return pd.DataFrame({
        "doc_id": frame["doc_id"].to_numpy()[row[head]], "row_key": frame["row_key"].to_numpy()[row[head]],
        "start": start[head], "count": np.diff(np.append(head, len(row)))})


def _induced(width: int):
    """Stage 3, dealt by name and sorted by name, surrounding and document."""
    def whole(frame: pd.DataFrame, count) -> pd.DataFrame:
        return pd.DataFrame({"doc_id": frame["doc_id"], "row_key": frame["row_key"], "start": frame["start"], "count": count})

    def run(frames):
        rest: pd.DataFrame | None = None
        for frame in frames:
            known = frame["lead"].to_numpy() < 0
            if known.any():
                yield whole(frame[known], -frame["lead"][known].astype("int64"))
                frame = frame[~known]
            if not len(frame):
                continue
            old = 0 if rest is None else len(rest)
            rest = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            # equal surroundings: the first, of the smallest document, covers the others and stands for them
            same = np.zeros(len(rest), bool)
            for c in ("name", "lead", "body"):
                v = rest[c].to_numpy()
                same[1:] = (v[1:] == v[:-1]) & (same[1:] if c != "name" else True)
            lead_row = np.maximum.accumulate(np.where(same, 0, np.arange(len(rest))))
            doc = rest["doc_id"].to_numpy()
            copy = same & (doc[lead_row] < doc)
            copy[:old] = False
            if copy.any():
                yield whole(rest[copy], rest["body"][copy].str.len().astype("int64") - (width - 1))
                rest = rest[~copy].reset_index(drop=True)
            if len(rest) < SORT_ROWS:
                continue
            name = rest["name"].to_numpy()
            cut = int(np.searchsorted(name, name[-1]))
            if cut:
                yield _ranges(rest.iloc[:cut], width)
                rest = rest.iloc[cut:].reset_index(drop=True)
        if rest is not None and len(rest):
            yield _ranges(rest, width)
    return run


def _merged(told, width: int, size: int) -> np.ndarray:
    """Byte spans [start, stop) of a document from its covered starts."""
    if told is None or not len(told):
        return np.empty((0, 2), np.int64)
    at = np.frombuffer(told, ">i8").astype(np.int64).reshape(-1, 2)
    at = at[np.argsort(at[:, 0], kind="stable")]
    start, stop = at[:, 0], np.maximum.accumulate(at[:, 0] + at[:, 1] + width - 1)
    head = np.flatnonzero(np.concatenate([[True], start[1:] > stop[:-1]]))
    return np.column_stack([start[head], np.minimum(stop[np.append(head[1:], len(stop)) - 1], size)])


def repeated_spans(docs: DataFrame, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """(doc_id, row_key, spans): byte ranges covered by strings of `width` bytes that also start in a smaller doc_id.

    `docs` needs doc_id and text; other columns are ignored. Null and short
    texts have no spans. A null doc_id takes no part. Rows that share a doc_id
    do not cover each other; `row_key` (hash of the text) keeps them apart.
    Texts of any length are handled in overlapping pieces.
    """
    ready(docs.sparkSession)
    plain = _keyed(docs)
    key, pick = ["doc_id", "row_key"], ["doc_id", "row_key", "text"]
    # null ids and short texts take no part; a copy has a smaller document with the same text
    size = F.octet_length("text")
    part = plain.where(F.col("doc_id").isNotNull() & (size >= width)).select(
        *key, size.cast("long").alias("size"), F.unhex(F.sha2("text", 256)).alias("digest"))
    first = part.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("last > first")
    copies = staged(part.join(first, "digest").where("doc_id > first").select(*key, "size").distinct())
    text = plain.where(F.col("doc_id").isNotNull()).select(*pick)
    asked = text.join(copies.select(*key), key, "left_anti").select(*pick).mapInPandas(_name_rows(width, seed), _NAMES)
    shared = asked.repartition("name").sortWithinPartitions("name").mapInPandas(
        _shared, "doc_id long, row_key long, known binary")
    by_doc = staged(shared.groupBy(*key).agg(F.listagg("known").alias("known")))
    tuples = text.join(by_doc, key).select(*pick, "known").mapInPandas(_suffix_rows(width, seed), _SUFFIXES)
    spread = F.when(F.col("lead") < 0, F.xxhash64("row_key", "start")).otherwise(F.col("name"))
    ranges = tuples.withColumn("name", spread).repartition("name").sortWithinPartitions("name", "lead", "body", "doc_id").mapInPandas(
        _induced(width), "doc_id long, row_key long, start long, count long")
    whole = copies.select(*key, F.lit(0).cast("long").alias("start"), (F.col("size") - (width - 1)).alias("count"))
    # 16 bytes a range, one value a document
    packed = F.unhex(F.concat(*(F.lpad(F.hex(c), 16, "0") for c in ("start", "count"))))
    return staged(ranges.unionByName(whole).select(*key, packed.alias("span")).groupBy(*key).agg(F.listagg("span").alias("spans")))


def _keyed(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("row_key"))


def remove_repeats(docs: DataFrame, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    spans = repeated_spans(docs, width, seed)

    def run(frames):
        for frame in frames:
            out = []
            for text, told in zip(frame["text"], frame["spans"]):
                data = text.encode("utf-8", "replace")
                cut = _merged(told, width, len(data))
                kept, at = hashlib.sha256(), 0
                for a, b in cut:
                    kept.update(data[at:a])
                    at = b
                kept.update(data[at:])
                out.append((len(data), int((cut[:, 1] - cut[:, 0]).sum()), len(cut), kept.hexdigest()))
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), **dict(zip(
                ("n_bytes", "n_removed", "n_spans", "kept_sha256"), zip(*out)))}) if out else frame.head(0)

    return _keyed(docs).join(spans, ["doc_id", "row_key"], "left").select("doc_id", "text", "spans").mapInPandas(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """The documents, all columns kept, with the repeated spans cut out of `text` and n_chars (if there) counted anew.

    A code point that a span covers only in part is kept. Null texts stay null.
    """
    spans = repeated_spans(docs, width, seed)

    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, told in zip(texts, spans):
            if text is None or told is None or not len(told):
                out.append(text)
                continue
            data, kept, at = text.encode("utf-8", "replace"), [], 0
            for a, b in _merged(told, width, len(data)):
                while a < b and data[a] & 0xC0 == 0x80:
                    a += 1
                while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
                    b -= 1
                kept.append(data[at:a])
                at = b
            out.append(b"".join([*kept, data[at:]]).decode("utf-8"))
        return pd.Series(out, dtype=object)

    cut_udf = F.pandas_udf(cut, "string")
    marked = docs.withColumn("_row_key", F.xxhash64(text_or_empty())).alias("d").join(
        spans.select(F.col("doc_id").alias("_doc"), F.col("row_key").alias("_key"), "spans").withColumnRenamed("spans", "_spans"),
        (F.col("d.doc_id") == F.col("_doc")) & (F.col("_row_key") == F.col("_key")), "left")
    out = marked.withColumn("text", cut_udf("text", "_spans"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
