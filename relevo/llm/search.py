"""Ranked lexical search by dense blocked matrix products (operator 12).

Method: the items' terms are a compact vocabulary.  Items are dealt into tiles
of at most ``ITEMS`` with the terms of their own as columns; documents are read
in tiles, whose terms outside the vocabulary are left out at once.  A document
tile is a dense matrix of impacts, an item tile one of term weights, and one
BLAS product in float64 scores every document of the one against every item of
the other.  Weights and impacts are whole numbers, so a product is exact as
long as its sums stay below 2**53: a tile's columns are cut where the sum of an
item's weights times the largest impact would reach that, and the parts are
added as 64-bit integers.

Score of a document: the sum over the item's terms, once each, of
``w * ((10**9 * tf) div (1000 * tf + 8 * m))`` with
``w = floor(1000 * ln((2N + 2) / (2df + 1)))`` and ``m = 10 + (90 * n * N) div L``
(``N`` documents with a term, ``L`` terms in all, ``n`` in the document).

A task keeps the best ``k`` of every item.  From a tile it takes what reaches
the item's ``k``-th score so far or the tile's own, whichever is higher, with
all that equal it, so ties are cut by id only.  At most ``k`` rows an item
leave a task, and a window over the item picks the best of them.

The vocabulary is broadcast in groups of items of at most ``GROUP`` terms (or
one item); further groups read the documents again.

Defined results: each row of the items is an item, also where rows repeat or
have no id; an item or a document with a null text, or without terms, scores
nothing and is not listed.  Rows that share an id are documents of their own;
a document without an id counts and is ranked behind its equals.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Batches, collect_table, summed_tables
from .words import Words, blocks

ITEMS, GROUP, TILE = 64, 1 << 16, 512
IMPACT = 1_000_000  # no impact is larger
EXACT = 1 << 53
GAP = np.ones(256, bool)  # what is no ASCII letter or digit parts terms
GAP[48:58] = GAP[65:91] = GAP[97:123] = GAP[128:] = False


@dataclass
class Group:
    """Items with their vocabulary (sorted term hashes); ``terms[i]`` are the
    places of item ``i``'s terms in it."""

    ids: list
    vocabulary: np.ndarray
    terms: list[np.ndarray]


def term_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The distinct term hashes of each text."""
    out = []
    for w in blocks(pa.array(texts, pa.string()), space=GAP):
        h = w.hashes()
        out += [np.unique(h[w.ptr[i]:w.ptr[i + 1]]) for i in range(w.n)]
    return out


def item_groups(items: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[Group]:
    """Groups of items of at most ``most`` terms (or one item); one is held at a time."""
    ids, sets, held = [], [], 0

    def group() -> Group:
        vocabulary = np.unique(np.concatenate(sets))
        return Group(ids, vocabulary, [np.searchsorted(vocabulary, s) for s in sets])

    for r in items.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).toLocalIterator():
        own = term_sets([r.t])[0]
        if not len(own):
            continue
        if held and held + len(own) > most:
            yield group()
            ids, sets, held = [], [], 0
        ids.append(r.i), sets.append(own)
        held += len(own)
    if sets:
        yield group()


def occurrences(w: Words, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, place in the vocabulary and count of its terms in a block, by text."""
    h = w.hashes()
    at = np.searchsorted(vocabulary, h)
    at[at == len(vocabulary)] = 0
    known = vocabulary[at] == h
    key, tf = np.unique(w.rows()[known] * len(vocabulary) + at[known], return_counts=True)
    return key // len(vocabulary), key % len(vocabulary), tf


def statistics(docs: DataFrame, text_col: str, vocabulary: np.ndarray) -> tuple[int, int, np.ndarray]:
    """``N``, ``L`` and each vocabulary term's ``df`` over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    shape = (len(vocabulary) + 2,)

    def fill(b: pa.RecordBatch, table: np.ndarray) -> None:
        for w in blocks(b.column(0), space=GAP):
            table[:-2] += np.bincount(occurrences(w, shared.value)[1], minlength=len(table) - 2)
            table[-2] += np.count_nonzero(np.diff(w.ptr))
            table[-1] += len(w)

    got = collect_table(summed_tables(docs.select(F.col(text_col).alias("text")), fill, shape), shape)
    return int(got[-2]), int(got[-1]), got[:-2]


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def item_tiles(group: Group, w: np.ndarray, size: int = ITEMS, exact: int = EXACT):
    """``(items, [(columns, weights), ...])``: the numbers of a tile's items, and
    its parts, each with terms of the vocabulary as columns and the weights
    (items by columns); no item's weights times ``IMPACT`` reach ``exact`` in a part."""
    out = []
    for lo in range(0, len(group.ids), size):
        own = group.terms[lo:lo + size]
        columns = np.unique(np.concatenate(own))
        dense = np.zeros((len(own), len(columns)))
        for i, t in enumerate(own):
            dense[i, np.searchsorted(columns, t)] = w[t]
        parts, a = [], 0
        while a < len(columns):
            heavy = np.cumsum(dense[:, a:], axis=1).max(axis=0) * IMPACT >= exact
            b = a + max(1, int(heavy.argmax()) if heavy.any() else len(columns) - a)
            parts.append((columns[a:b], dense[:, a:b]))
            a = b
        out.append((np.arange(lo, lo + len(own)), parts))
    return out


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, all_terms: int) -> np.ndarray:
    """Impacts of counts ``tf`` in documents of ``n`` terms."""
    sizes, at = np.unique(n, return_inverse=True)
    m = np.array([10 + 90 * s * n_docs // all_terms for s in sizes.tolist()], np.int64)[at]
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


class Best:
    """The best ``k`` documents of each item of a tile so far: higher scores
    first, then smaller ids, documents without an id last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.no_id = np.zeros(0, bool)
        self.bar = np.ones(items, np.int64)  # what a score must reach

    def add(self, scores: np.ndarray, doc: np.ndarray, no_id: np.ndarray) -> None:
        """``scores``: items by documents."""
        bar = self.bar
        if scores.shape[1] > self.k:
            bar = np.maximum(bar, np.partition(scores, -self.k, axis=1)[:, -self.k])
        r, c = np.nonzero(scores >= bar[:, None])
        if not len(r):
            return
        item = np.r_[self.item, r]
        score, doc, no_id = np.r_[self.score, scores[r, c]], np.r_[self.doc, doc[c]], np.r_[self.no_id, no_id[c]]
        order = np.lexsort((doc, no_id, -score, item))
        ordered = item[order]
        kept = order[np.arange(len(item)) - np.searchsorted(ordered, ordered) < self.k]
        self.item, self.score, self.doc, self.no_id = (x[kept] for x in (item, score, doc, no_id))
        count = np.bincount(self.item, minlength=len(self.bar))
        last = np.cumsum(count) - 1
        full = count == self.k
        self.bar[full] = self.score[last[full]]


def _ranked_group(docs: DataFrame, group: Group, k: int, id_col: str, text_col: str) -> DataFrame:
    """At most ``k`` rows a task and item: ``item`` (its number), ``doc_id``, ``score``."""
    n_docs, all_terms, df = statistics(docs, text_col, group.vocabulary)
    tiles = item_tiles(group, weights(n_docs, df))
    shared = docs.sparkSession.sparkContext.broadcast((group.vocabulary, tiles))

    def run(batches: Batches) -> Batches:
        vocabulary, tiles = shared.value
        best = [Best(len(numbers), k) for numbers, _ in tiles]
        place = np.full(len(vocabulary), -1)
        for b in batches:
            no_id = b.column(0).is_null().to_numpy(zero_copy_only=False)
            ids = b.column(0).fill_null(0).to_numpy()
            for w in blocks(b.column(1), space=GAP):
                if not len(w):
                    continue
                row, term, tf = occurrences(w, vocabulary)
                size = np.diff(w.ptr)
                for lo in range(0, w.n, TILE):
                    a, e = np.searchsorted(row, [lo, lo + TILE])
                    if a == e:
                        continue
                    # documents without a term of the vocabulary score 0
                    held, r = np.unique(row[a:e], return_inverse=True)
                    t = term[a:e]
                    x = impacts(tf[a:e], size[row[a:e]], n_docs, all_terms)
                    for (numbers, parts), found in zip(tiles, best):
                        scores = np.zeros((len(numbers), len(held)), np.int64)
                        for columns, dense in parts:
                            place[columns] = np.arange(len(columns))
                            c = place[t]
                            use = c >= 0
                            tile = np.zeros((len(columns), len(held)))
                            tile[c[use], r[use]] = x[use]
                            scores += (dense @ tile).astype(np.int64)
                            place[columns] = -1
                        found.add(scores, ids[w.lo + held], no_id[w.lo + held])
        for (numbers, _), found in zip(tiles, best):
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers[found.item]), pa.array(found.doc, pa.int64(), mask=found.no_id), pa.array(found.score)],
                names=["item", "doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(run, "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = 10, item_col: str = "item_id",
                     item_text: str = "text", id_col: str = "doc_id", text_col: str = "text",
                     group_terms: int = GROUP) -> DataFrame:
    """``item_id`` (as in ``items``), ``rank`` (from 1), ``doc_id``, ``score`` of
    each item's ``k`` best documents with a score above 0."""
    spark = docs.sparkSession
    kind = items.schema[item_col].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for group in item_groups(items, item_col, item_text, group_terms):
        found = _ranked_group(docs, group, k, id_col, text_col)
        names = spark.createDataFrame(list(enumerate(group.ids)), f"item long, item_id {kind}")
        # one row an item of the group, whose terms are bounded
        out = out.unionByName(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out
