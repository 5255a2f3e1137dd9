"""Numpy work on units of a bounded size: rows of a unit arrive together in a
sorted partition and are handed over as columns."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batches

KEYS = ["bucket", "_i", "_j"]


def _columns(t: pa.Table) -> dict[str, np.ndarray]:
    out = {}
    for n in t.column_names:
        c = t[n].combine_chunks()
        if pa.types.is_list(c.type):  # a matrix where all rows are as long
            flat, ends = c.flatten().to_numpy(zero_copy_only=False), np.cumsum(c.value_lengths().to_numpy())
            even = len(c) and len(flat) == len(c) * ends[0] and (np.diff(ends) == ends[0]).all()
            out[n] = flat.reshape(len(c), -1) if even else np.split(flat, ends[:-1])
        else:
            out[n] = c.to_numpy(zero_copy_only=False)
    return out


def over_units(rows: DataFrame, emit: Callable[[dict], list[tuple]], names: list[str], schema: str) -> DataFrame:
    """Call ``emit`` with the columns of each unit (``bucket``, ``_i``, ``_j``);
    it returns parts of output columns.  A unit's size is bounded by how the
    units were made, and only one is held at a time beside an Arrow batch."""

    def run(batches: Batches) -> Batches:
        held: list[pa.RecordBatch] = []

        def done(end: bool) -> list[tuple]:
            t = pa.Table.from_batches(held).combine_chunks()
            change = np.zeros(len(t), bool)
            for k in KEYS:
                x = t[k].to_numpy()
                change[1:] |= x[1:] != x[:-1]
            cuts = np.r_[0, np.flatnonzero(change), len(t)]
            full = cuts if end else cuts[:-1]
            parts = []
            for a, b in zip(full[:-1].tolist(), full[1:].tolist()):
                if b > a:
                    parts += emit(_columns(t.slice(a, b - a)))
            held.clear()
            if not end:
                held.extend(t.slice(int(cuts[-2])).to_batches())
            return parts

        def batch(parts):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([p[k] for p in parts])) for k in range(len(names))], names=names)

        for b in batches:
            for lo in range(0, b.num_rows, 2048):
                held.append(b.slice(lo, 2048))
                parts = done(False)
                if parts:
                    yield batch(parts)
        if held:
            parts = done(True)
            if parts:
                yield batch(parts)

    rows = rows.repartition(*KEYS).sortWithinPartitions(*KEYS)
    return rows.mapInArrow(run, schema)


def sides(g: dict) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of a unit's two blocks (the same rows where they are one)."""
    return np.flatnonzero(g["_mine"] == g["_i"]), np.flatnonzero(g["_mine"] == g["_j"])


def forest(weight: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """A maximum spanning forest of the pairs with ``weight > 0`` (rows against
    columns; ``same``: both are the same nodes), by rounds in which every tree
    takes its best edge outwards.  Returns row and column numbers."""
    n, m = weight.shape
    own = np.arange(n)
    other = own if same else n + np.arange(m)
    label = np.arange(n if same else n + m)
    a, b = [], []
    while True:
        out = np.where(label[own][:, None] != label[other][None, :], weight, 0)
        best = out.argmax(axis=1)
        rows = np.flatnonzero(out[own, best] > 0)
        if not len(rows):
            break
        # one edge a tree of the rows' side, the heaviest; ties by place
        order = rows[np.lexsort((rows, -out[rows, best[rows]]))]
        joined = False
        parent = label.copy()

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        seen = set()
        for r in order.tolist():
            tree = label[r]
            if tree in seen:
                continue
            seen.add(tree)
            x, y = root(label[r]), root(label[other[best[r]]])
            if x != y:
                parent[max(x, y)] = min(x, y)
                a.append(r), b.append(int(best[r]))
                joined = True
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
        label = parent[label]
        if not joined:
            break
    return np.array(a, np.int64), np.array(b, np.int64)


def overlaps(x: np.ndarray, y: np.ndarray, step: int = 4096) -> np.ndarray:
    """Numbers of common values of every row of ``x`` and every row of ``y``;
    a row's values are distinct, negative padding counts for nothing."""
    values, at = np.unique(np.concatenate([x.ravel(), y.ravel()]), return_inverse=True)
    inx, iny = at[:x.size].reshape(x.shape), at[x.size:].reshape(y.shape)
    both = np.zeros(len(values), bool)
    both[np.intersect1d(inx, iny)] = True
    both &= values >= 0
    place = np.cumsum(both) - 1
    out = np.zeros((len(x), len(y)), np.float32)
    for lo in range(0, int(both.sum()), step):
        part = both & (place >= lo) & (place < lo + step)
        width = min(step, int(both.sum()) - lo)

        def dense(ix):
            d = np.zeros((len(ix), width), np.float32)
            r, c = np.nonzero(part[ix])
            d[r, place[ix[r, c]] - lo] = 1
            return d

        out += dense(inx) @ dense(iny).T
    return out
