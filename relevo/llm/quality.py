"""Document quality by histogram gradient-boosted trees (operator 11).

Method: a text becomes ``STATISTICS`` numbers (lengths, shares of kinds of
characters, words, lines and repeats), computed for whole blocks of texts with
numpy.  A feature is cut into at most ``BINS`` bins at quantiles of the learning
rows.  Trees are grown level by level: every partition sums the gradients and
curvatures of its rows by node, feature and bin (as whole numbers, so that
the order of adding does not matter), and the driver adds these histograms,
whose size is fixed, and takes the best cut of each node.  The finished trees
lie in flat arrays by node number; all rows walk down all trees at once by array
look-ups.

Learning uses at most about ``sample`` labelled rows, drawn by a hash of id and
features (a documented bound); statistics and scores cover every text.

Defined results: a null text counts as empty and is scored like it; an id with
several labels is of low quality if one says so; rows that share an id are all
scored and all learned from; a row without an id is scored but never learned
from; without labels of both kinds every score is their share (0.5 if none).
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Batches, stage
from .words import U, blocks, mix, shingles

BINS = 64
_KINDS = ["upper", "lower", "digit", "other", "space", "newline", "stop", "comma", "quote", "symbol"]
_KIND = np.full(256, _KINDS.index("symbol"), np.uint8)
for _k, _chars in (("upper", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("lower", b"abcdefghijklmnopqrstuvwxyz"),
                   ("digit", b"0123456789"), ("other", bytes(range(128, 256))), ("space", b" \t\v\f\r"),
                   ("newline", b"\n"), ("stop", b".?!:"), ("comma", b",;-"), ("quote", b"'\"()")):
    _KIND[list(_chars)] = _KINDS.index(_k)

STATISTICS = [
    "chars", "words", "lines", "words_a_line", "word_length", "word_spread", "longest",
    *(f"share_{k}" for k in _KINDS), "cased_words", "wordless", "odd_ends", "distinct_words", "top_word",
    "distinct_pairs", "distinct_fives", "distinct_lines", "line_ends", "short_words", "byte_entropy", "pair_entropy"]


def _sums(x: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Sums of ``x`` over the stretches between the offsets ``ptr``."""
    total = np.zeros(len(x) + 1, np.float64)
    np.cumsum(x, out=total[1:])
    return total[ptr[1:]] - total[ptr[:-1]]


def _repeats(h: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: the share of distinct hashes, that of the most frequent one
    and the entropy (in bits, over its largest possible value)."""
    n, size = len(ptr) - 1, np.maximum(np.diff(ptr), 1)
    text = np.repeat(np.arange(n), np.diff(ptr))
    order = np.lexsort((h, text))
    g, t = h[order], text[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (t[1:] != t[:-1])
    at = np.flatnonzero(new)
    count, of = np.diff(np.r_[at, len(g)]), t[at]
    top = np.zeros(n)
    np.maximum.at(top, of, count)
    p = count / size[of]
    entropy = np.bincount(of, -p * np.log2(p), n) / np.maximum(np.log2(size), 1)
    return np.bincount(of, minlength=n) / size, top / size, entropy


def statistics(col: pa.Array) -> np.ndarray:
    """The statistics of a text column, one row a text."""
    out = np.zeros((len(col), len(STATISTICS)), np.float32)
    for w in blocks(col):
        kind = _KIND[w.data]
        by_kind = [_sums(kind == k, w.offs) for k in range(len(_KINDS))]
        size = np.maximum(np.diff(w.offs), 1)
        n = np.diff(w.ptr)
        some = np.maximum(n, 1)
        length = w.end - w.start
        letters = np.zeros(len(w.data) + 1, np.int64)
        np.cumsum((kind == 0) | (kind == 1) | (kind == 3), out=letters[1:])
        small = np.zeros(len(w.data) + 1, np.int64)
        np.cumsum(kind == 1, out=small[1:])
        has = letters[w.end] - letters[w.start]
        last = kind[w.end - 1]
        h = w.hashes()
        word, top, entropy = _repeats(h, w.ptr)
        pairs = _repeats(*shingles(h, w.ptr, 2))
        fives = _repeats(*shingles(h, w.ptr, 5))
        # lines by the sum of their words' hashes at their places
        newline = np.flatnonzero(w.data == 10)
        line = np.searchsorted(newline, w.start)
        row = w.rows()
        first = np.flatnonzero(np.r_[True, (line[1:] != line[:-1]) | (row[1:] != row[:-1])]) if len(h) else np.zeros(0, int)
        nth = np.arange(len(h)) - np.repeat(first, np.diff(np.r_[first, len(h)]))
        digest = np.add.reduceat(mix(h + nth.astype(U)), first) if len(h) else h
        lines = np.bincount(row[first], minlength=w.n)
        line_ptr = np.r_[0, np.cumsum(lines)]
        full_stop = last[np.r_[first[1:], len(h)] - 1] == _KINDS.index("stop") if len(h) else np.zeros(0, bool)
        data = np.bincount(np.repeat(np.arange(w.n), np.diff(w.offs)) * 256 + LOWERED[w.data],
                           minlength=256 * w.n).reshape(-1, 256) / size[:, None]
        mean = _sums(length, w.ptr) / some
        longest = np.zeros(w.n)
        np.maximum.at(longest, row, length)
        columns = [
            np.log1p(np.diff(w.offs)), np.log1p(n), np.log1p(lines), np.log1p(n / np.maximum(lines, 1)), mean,
            np.sqrt(np.maximum(_sums(length.astype(float) ** 2, w.ptr) / some - mean ** 2, 0)), np.log1p(longest),
            *(x / size for x in by_kind),
            _sums((has > 1) & (small[w.end] == small[w.start]), w.ptr) / some, _sums(has == 0, w.ptr) / some,
            _sums(last == _KINDS.index("symbol"), w.ptr) / some, word, top, pairs[0], fives[0],
            _repeats(digest, line_ptr)[0], _sums(full_stop, line_ptr) / np.maximum(lines, 1),
            _sums(length <= 3, w.ptr) / some,
            -(data * np.log2(np.where(data > 0, data, 1))).sum(axis=1), pairs[2]]
        out[w.lo:w.lo + w.n] = np.stack(columns, axis=1)
    return out


LOWERED = np.arange(256)
LOWERED[65:91] += 32


@dataclass
class Trees:
    """Flat trees: node ``k`` of a tree has the children ``2k + 1`` and
    ``2k + 2``; a row goes right where its bin of ``feature`` is above ``cut``."""

    edges: list[np.ndarray]  # of each feature's bins
    base: float              # log-odds to begin with
    depth: int
    feature: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.int16))
    cut: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.uint8))
    leaf: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "left") for k, e in enumerate(self.edges)], axis=1).astype(np.uint8)

    def leaves(self, bins: np.ndarray, depth: int | None = None) -> np.ndarray:
        """Each row's node (rows by trees) after ``depth`` steps."""
        node = np.zeros((len(bins), len(self.feature)), np.int64)
        tree, row = np.arange(len(self.feature)), np.arange(len(bins))[:, None]
        for _ in range(self.depth if depth is None else depth):
            node = 2 * node + 1 + (bins[row, self.feature[tree, node]] > self.cut[tree, node])
        return node

    def margin(self, bins: np.ndarray, step: int = 8192) -> np.ndarray:
        out = np.full(len(bins), self.base)
        inner, tree = (1 << self.depth) - 1, np.arange(len(self.feature))
        for lo in range(0, len(bins) if len(tree) else 0, step):
            out[lo:lo + step] += self.leaf[tree, self.leaves(bins[lo:lo + step]) - inner].sum(axis=1)
        return out


def _chance(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


_UNIT = 1 << 20  # gradients are added as whole numbers of this part of one


def histograms(rows: DataFrame, model: Trees, tree: Trees, level: int) -> np.ndarray:
    """Sums of gradients, curvatures and rows by node of a ``level`` of the
    growing ``tree``, feature and bin, over partitions of ``bins binary, y int``."""
    features, nodes = len(model.edges), 1 << level
    shape = (3, nodes, features, BINS)

    def add(batches: Batches) -> Batches:
        total = np.zeros(shape, np.int64)
        for b in batches:
            x = np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint8).reshape(-1, features)
            y = b.column(1).to_numpy()
            p = _chance(model.margin(x))
            values = (np.rint((y - p) * _UNIT), np.rint(p * (1 - p) * _UNIT), np.ones(len(y)))
            node = tree.leaves(x, level)[:, 0] - (nodes - 1)
            for k in range(features):
                at = node * BINS + x[:, k]
                for total_of, v in zip(total, values):
                    total_of[:, k] += np.bincount(at, v, nodes * BINS).astype(np.int64).reshape(nodes, BINS)
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], names=["part"])

    # as many rows as the learning rows have partitions, each of a bounded size
    parts = rows.mapInArrow(add, "part binary").collect()
    return sum((np.frombuffer(zlib.decompress(r.part), np.int64) for r in parts),
               np.zeros(int(np.prod(shape)), np.int64)).reshape(shape)


def best_cuts(h: np.ndarray, ridge: float, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature and bin of each node's best cut (a bin no row is above where no
    cut gains) and the gradients and curvatures of its two sides."""
    total = np.cumsum(h, axis=-1)
    left = total[..., :-1].astype(np.float64)
    right = total[..., -1:] - left
    g, c = np.stack([left[0], right[0]]) / _UNIT, np.stack([left[1], right[1]]) / _UNIT
    score = (g ** 2 / (c + ridge)).sum(axis=0)
    score[(left[2] < least) | (right[2] < least)] = -1
    node = np.arange(h.shape[1])
    flat = score.reshape(len(node), -1)
    best = flat.argmax(axis=1)
    feature, cut = best // score.shape[-1], best % score.shape[-1]
    g, c = g[:, node, feature, cut], c[:, node, feature, cut]
    none = flat[node, best] < g.sum(axis=0) ** 2 / (c.sum(axis=0) + ridge) + 1e-9
    feature, cut = np.where(none, 0, feature), np.where(none, BINS, cut)
    whole = total[:2, node, 0, -1] / _UNIT
    sides = np.stack([np.where(none, whole[0], g), np.where(none, whole[1], c)])
    return feature, cut, sides


def grow(rows: DataFrame, model: Trees, rate: float, ridge: float, least: int) -> Trees:
    """One more tree on the rows' gradients; its levels are one job each."""
    depth = model.depth
    tree = Trees(model.edges, 0.0, depth, np.zeros((1, (1 << depth) - 1), np.int16),
                 np.full((1, (1 << depth) - 1), BINS, np.uint8), np.zeros((1, 1 << depth)))
    for level in range(depth):
        feature, cut, sides = best_cuts(histograms(rows, model, tree, level), ridge, least)
        at = (1 << level) - 1 + np.arange(1 << level)
        tree.feature[0, at], tree.cut[0, at] = feature, cut
    # the last level's sides are the leaves: left and right of each node in turn
    g, c = sides.transpose(0, 2, 1).reshape(2, -1)
    tree.leaf[0] = rate * g / (c + ridge)
    return tree


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``x``, the statistics of its text."""

    def run(batches: Batches) -> Batches:
        for b in batches:
            x = statistics(b.column(1))
            flat = pa.array(x.ravel())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.FixedSizeListArray.from_arrays(flat, x.shape[1]).cast(pa.list_(pa.float32()))],
                names=["doc_id", "x"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, x array<float>")


def _matrix(col: pa.Array) -> np.ndarray:
    return col.flatten().to_numpy().reshape(len(col), -1)


def fit(stats: DataFrame, labels: DataFrame, learn: Column, label_col: str = "quality", id_col: str = "doc_id",
        rounds: int = 40, depth: int = 3, rate: float = 0.2, ridge: float = 1.0, least: int = 10,
        sample: int = 40_000, parts: int = 6) -> Trees:
    """Trees from the rows of ``stats`` (``doc_id``, ``x``) with a label where
    ``learn`` (over ``id_col`` of ``labels``) holds."""
    known = labels.select(F.col(id_col).cast("long").alias("i"), F.col(label_col).cast("int").alias("y"),
                          learn.alias("ok")).where("ok and i is not null and y in (0, 1)").groupBy("i").agg(
        F.min("y").alias("y"))
    rows = stats.join(known, stats["doc_id"] == known["i"]).select("x", "y", F.xxhash64("doc_id", "x").alias("h"))
    rows = stage(rows, "quality-rows")
    n = rows.count()
    # at most about `sample` rows from here on, whatever the labels hold
    drawn = rows.where(F.pmod("h", F.lit(1 << 30)) < int((1 << 30) * min(1, sample / max(n, 1))))
    got = drawn.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s")).first()
    share = got.s / got.n if got.n else 0.5
    if share in (0.0, 1.0) or not got.n:
        return Trees([np.zeros(0)] * len(STATISTICS), float(np.clip(np.log(share or 1e-13) - np.log(1 - share or 1e-13), -30, 30)),
                     depth)
    base = float(np.log(share / (1 - share)))
    # a quarter of the sample at most, a few numbers a row, for the bins
    few = drawn.where(F.pmod("h", F.lit(1 << 30)) < int((1 << 30) * min(1, sample / 4 / max(n, 1)))).select("x").toArrow()
    x = np.sort(_matrix(few.column(0).combine_chunks()), axis=0) if len(few) else np.zeros((1, len(STATISTICS)))
    cuts = x[np.unique(np.linspace(0, len(x) - 1, BINS + 1).astype(int)[1:-1])]
    model = Trees([np.unique(c) for c in cuts.T], base, depth)

    def binned(batches: Batches) -> Batches:
        for b in batches:
            x = model.bins(_matrix(b.column(0)))
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), b.column(1)],
                                             names=["bins", "y"])

    # a bounded sample: few partitions, however many the session's shuffles have
    drawn = drawn.select("x", "y").repartition(parts).mapInArrow(binned, "bins binary, y int")
    drawn = stage(drawn, "quality-bins").persist()
    try:
        for _ in range(rounds):
            tree = grow(drawn, model, rate, ridge, least)
            model = Trees(model.edges, base, depth, *(np.concatenate([a, b]) if len(a) else b for a, b in (
                (model.feature, tree.feature), (model.cut, tree.cut), (model.leaf, tree.leaf))))
    finally:
        drawn.unpersist()
    return model


def scored(stats: DataFrame, model: Trees) -> DataFrame:
    """``doc_id`` and ``score``, the chance of a high quality, of each row of ``stats``."""
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches: Batches) -> Batches:
        for b in batches:
            p = _chance(shared.value.margin(shared.value.bins(_matrix(b.column(1))))) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p)], names=["doc_id", "score"])

    return stats.select("doc_id", "x").mapInArrow(run, "doc_id long, score double")
