"""Near-duplicate vectors by sorted projection passes: lexicographic order of hashed signs, bounded windows, union."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from martworks.llm.common import Forest, components, ready, staged
from martworks.llm.links import count_links

THRESHOLD = 0.95
WINDOW = 48
RECALL = 0.999
BITS = 62
# least cosine of two centred vectors at the threshold that the number of passes is made for
MIN_CENTRED = 0.5
BLOCK = 2_000


def passes_needed(rows: int, window: int, threshold: float, recall: float, spread: float = 1.0) -> int:
    """Passes after which a pair at the threshold has met in a window with the wanted probability.

    Two vectors agree in one sign with p = 1 - angle / pi, and meet once they
    agree in the log2(rows / window) leading signs that make a run as short as a
    window. The angle is that between the centred vectors: `spread` is their mean
    squared length, and a pair at the threshold differs by 2 (1 - threshold).
    """
    angle = math.acos(max(MIN_CENTRED, 1 - (1 - threshold) / max(spread, 1e-9)))
    agree = 1 - angle / math.pi
    depth = max(1.0, math.log2(max(2.0, rows / window)))
    return max(4, math.ceil(math.log(1 - recall) / math.log(1 - agree ** depth)))


def _projections(dim: int, which: int) -> np.ndarray:
    return np.random.default_rng([20, dim, which]).standard_normal((dim, BITS))


def _sums(frames):
    """Sum of the vectors of each length in a partition, one row per component."""
    total: dict[int, np.ndarray] = {}
    count: dict[int, int] = {}
    for frame in frames:
        length = np.array([len(b) for b in frame["body"]]) // 8
        for dim in np.unique(length):
            own = np.flatnonzero(length == dim)
            unit = np.frombuffer(b"".join(frame["body"].iloc[own]), np.float64).reshape(-1, dim)
            total[int(dim)] = total.get(int(dim), 0.0) + unit.sum(axis=0)
            count[int(dim)] = count.get(int(dim), 0) + len(own)
    for dim, v in total.items():
        yield pd.DataFrame({"dim": dim, "at": np.arange(dim), "total": v, "n": count[dim]})


def centres(classes: DataFrame) -> dict[int, np.ndarray]:
    """Mean unit vector by length: one vector per length that occurs reaches the driver."""
    means = classes.select("body").mapInPandas(_sums, "dim int, at int, total double, n long").groupBy("dim", "at").agg(
        (F.sum("total") / F.sum("n")).alias("mean")).groupBy("dim").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "mean"))), lambda x: x["mean"]).alias("mean"))
    return {r["dim"]: np.array(r["mean"]) for r in means.collect()}


def _keys(passes: int, middle: dict[int, np.ndarray]):
    """A row per vector and pass with its sign key and its code, the components as 8-bit numbers.

    The signs are those of the centred vector: a direction that all vectors
    share would give them all the same leading signs.
    """
    def run(frames):
        for frame in frames:
            body = list(frame["body"])
            length = np.array([len(b) for b in body]) // 8
            for dim in np.unique(length):
                own = np.flatnonzero(length == dim)
                unit = np.frombuffer(b"".join(body[i] for i in own), np.float64).reshape(-1, dim)
                centred, code = unit - middle[int(dim)], codes(unit)
                for p in range(passes):
                    bits = centred @ _projections(int(dim), p) > 0
                    key = bits @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
                    yield pd.DataFrame({"dim": int(dim), "pass": p, "key": key, "id": frame["id"].to_numpy()[own], "code": code})
    return run


def codes(unit: np.ndarray) -> list[bytes]:
    """Scale (32-bit) and components as multiples of it between -127 and 127."""
    scale = (np.abs(unit).max(axis=1) / 127).astype(np.float32)
    # rounded up, so that no component passes 127
    scale = np.nextafter(scale, np.float32(np.inf))
    steps = np.rint(unit / scale[:, None].astype(np.float64)).astype(np.int8)
    return [a.tobytes() + b.tobytes() for a, b in zip(scale, steps)]


def decoded(code: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of the codes and a bound on the length of what rounding took from each."""
    raw = np.frombuffer(b"".join(code), np.uint8).reshape(len(code), -1)
    scale = raw[:, :4].copy().view(np.float32).astype(np.float64)
    vectors = raw[:, 4:].view(np.int8) * scale
    return vectors, scale[:, 0] / 2 * math.sqrt(vectors.shape[1]) * (1 + 1e-6) + 1e-9


def _compare(window: int, threshold: float):
    """Sorted rows: each row against the `window` rows before it by their codes.

    Pairs that are linked whatever the rounding come out as trees of a bounded
    stretch, pairs that rounding leaves open as they are, with `sure` false.
    """
    def run(frames):
        tail: pd.DataFrame | None = None
        for frame in frames:
            rows = frame if tail is None else pd.concat([tail, frame], ignore_index=True)
            tail = rows.iloc[-window:]
            for _, part in rows.groupby(["dim", "pass"], sort=False):
                if len(part) < 2:
                    continue
                near, off = decoded(list(part["code"]))
                ids, forest, open_u, open_v = part["id"].to_numpy(), Forest(len(part)), [], []
                for s in range(1, min(window, len(part) - 1) + 1):
                    # |u v - u' v'| <= |u| |v - v'| + |v'| |u - u'| and |v'| <= 1 + |v - v'|
                    like = np.einsum("ij,ij->i", near[s:], near[:-s])
                    slack = off[s:] + off[:-s] + off[s:] * off[:-s]
                    for i in np.flatnonzero(like - slack >= threshold):
                        forest.link(int(i), int(i) + s)
                    maybe = np.flatnonzero((like + slack >= threshold) & (like - slack < threshold))
                    open_u.append(maybe), open_v.append(maybe + s)
                root = np.array([forest.root(i) for i in range(len(part))])
                u, v = ids, ids[root]
                a, b = np.concatenate(open_u), np.concatenate(open_v)
                apart = root[a] != root[b]
                a, b = ids[a[apart]], ids[b[apart]]
                yield pd.DataFrame({"u": np.concatenate([u[u != v], np.maximum(a, b)]),
                                    "v": np.concatenate([v[u != v], np.minimum(a, b)]),
                                    "sure": np.repeat([True, False], [int((u != v).sum()), len(a)])})
    return run


def _verified(threshold: float):
    def run(frames):
        for frame in frames:
            like = np.array([np.frombuffer(x, np.float64) @ np.frombuffer(y, np.float64)
                             for x, y in zip(frame["x"], frame["y"])], np.float64)
            yield frame.loc[like >= threshold, ["u", "v"]]
    return run


def cosine(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Double-precision cosine of every pair; vectors of unlike length are unlike."""
    size = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    out = np.full((len(left), len(right)), -1.0)
    for n in np.unique(size[0]):
        a, b = np.flatnonzero(size[0] == n), np.flatnonzero(size[1] == n)
        if len(b):
            x = np.frombuffer(b"".join(left[i] for i in a), np.float64).reshape(len(a), -1)
            y = np.frombuffer(b"".join(right[i] for i in b), np.float64).reshape(len(b), -1)
            out[np.ix_(a, b)] = x @ y.T
    return out


def _unit(vector: str):
    def run(frames):
        for frame in frames:
            out = []
            for v in frame[vector]:
                v = None if v is None else np.array([np.nan if x is None else x for x in v], np.float64)
                top = 0.0 if v is None or not len(v) or not np.isfinite(v).all() else np.abs(v).max()
                if top == 0:
                    out.append(None)
                    continue
                # scaled first, so that neither tiny nor huge components leave the range of a double
                v = v / top
                out.append((v / np.sqrt(v @ v) + 0.0).tobytes())
            yield pd.DataFrame({"vec_id": frame["vec_id"].astype("Int64"), "body": out})
    return run


def near_vectors(vectors: DataFrame, vector: str = "embedding", threshold: float = THRESHOLD, window: int = WINDOW,
                 recall: float = RECALL) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold a null or non-finite component
    link with nothing, like those with a null vec_id. Equal unit vectors are one
    class with a count. Each pass sorts the classes by the concatenated signs of
    random projections of the centred vectors and compares every class with the
    `window` before it; the number of passes follows from the row count, the
    spread around the mean and the wanted recall. Only keys and 8-bit codes are
    sorted; a pair that the codes leave open is decided on the vectors. The
    links of all passes are united to components, inside which all pairs are
    counted in blocks, so groups larger than a window lose nothing. Partition
    borders cut windows; other passes meet those pairs. Repeated vec_ids count
    as vectors of their own and share a component if linked.
    """
    ready(vectors.sparkSession)
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias(vector))
    units = staged(plain.mapInPandas(_unit(vector), "vec_id long, body binary").withColumn(
        "h", F.when(F.col("vec_id").isNotNull(), F.sha2("body", 256))))
    classes = staged(units.where("h is not null").groupBy("h").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("body").alias("body")))
    middle = centres(classes)
    # a mean of squared length m leaves 1 - m around it
    spread = min((1 - float(m @ m) for m in middle.values()), default=1.0)
    passes = passes_needed(max(1, classes.count()), window, threshold, recall, spread)
    keyed = classes.select("id", "body").mapInPandas(_keys(passes, middle), "dim int, pass int, key long, id long, code binary")
    order = ["dim", "pass", "key", "id"]
    # session default of partitions: a stretch of each pass per task
    laid = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    met = staged(laid.mapInPandas(_compare(window, threshold), "u long, v long, sure boolean"))
    body = lambda name, as_: classes.select(F.col("id").alias(name), F.col("body").alias(as_))
    decided = met.where("not sure").select("u", "v").distinct().join(body("u", "x"), "u").join(body("v", "y"), "v").mapInPandas(
        _verified(threshold), "u long, v long")
    groups = staged(components(met.where("sure").select("u", "v").unionByName(decided)))
    members = classes.join(groups.select(F.col("node").alias("id"), F.col("component").alias("grp")), "id").select(
        "grp", "id", "copies", "body", F.lit(1).alias("one"))
    linked = staged(count_links(members, "one", BLOCK, cosine, threshold))
    per_class = classes.select("h", "id", "copies").join(linked.select("id", "links"), "id", "left").join(
        groups.select(F.col("node").alias("id"), "component"), "id", "left").select(
        "h", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"))
    return units.select("vec_id", "h").join(per_class, "h", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
