"""Counts verified links inside groups of candidates, in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from martworks.llm.common import block_pairs


def joined(linked: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, columns) of each connected part of a matrix of links, rows without links left out.

    Parts are grown by whole rows and columns, each of which is read once.
    """
    seen_row, seen_column = np.zeros(len(linked), bool), np.zeros(linked.shape[1], bool)
    parts = []
    for first in np.flatnonzero(linked.any(axis=1)):
        if seen_row[first]:
            continue
        rows, columns, front = [], [], np.array([first])
        seen_row[first] = True
        while len(front):
            rows.append(front)
            reached = np.flatnonzero(linked[front].any(axis=0) & ~seen_column)
            seen_column[reached] = True
            columns.append(reached)
            front = np.flatnonzero(linked[:, reached].any(axis=1) & ~seen_row)
            seen_row[front] = True
        parts.append((np.concatenate(rows), np.concatenate(columns)))
    return parts


def count_links(members: DataFrame, weight: str, target: float, likeness: Callable, threshold: float) -> DataFrame:
    """(id, links, root): per member and pair of blocks, the copies it is linked to and the smallest id its links reach there.

    `members` has grp, id, copies, the column `body` and the `weight` column. All
    pairs of a group are compared, but only sums leave a task.
    likeness(list of bodies, list of bodies) -> matrix.
    """
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        # equal order wherever the piece is computed again
        frame = frame.sort_values("id", ignore_index=True)
        ids, copies = frame["id"].to_numpy(), frame["copies"].to_numpy()
        side = frame["side"].to_numpy()
        n = len(frame)
        if side[0] == -1:
            a = b = np.arange(n)
        else:
            a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        links, root = np.zeros(n, np.int64), ids.copy()
        if len(a) and len(b):
            bodies = list(frame["body"])
            linked = likeness([bodies[i] for i in a], [bodies[i] for i in b]) >= threshold
            if side[0] == -1:
                np.fill_diagonal(linked, False)
            links[a] += linked @ copies[b]
            if side[0] == -1:
                # rows and columns are the same members, so a part holds both sides of each
                np.fill_diagonal(linked, links > 0)
            else:
                links[b] += linked.T @ copies[a]
            for rows, columns in joined(linked):
                part = np.concatenate([a[rows], b[columns]])
                root[part] = ids[part].min()
        found = links > 0
        return pd.DataFrame({"id": ids[found], "links": links[found], "root": root[found]})

    return block_pairs(members, weight, target).select("grp", "i", "j", "side", "id", "copies", "body").groupBy(
        "grp", "i", "j").applyInPandas(run, "id long, links long, root long").groupBy("id").agg(
        F.sum("links").alias("links"), F.collect_set("root").alias("roots"))
