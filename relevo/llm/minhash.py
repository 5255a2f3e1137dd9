"""Near-duplicate documents by bottom-k sketches (operator 7).

Method: a document's set is its distinct ``WIDTH``-word shingles under one
hash function; its sketch is the ``K`` smallest.  Documents with equal sets
are one class.  Inverted lists of the retained values generate overlaps: two
sets with a Jaccard index of at least ``percent`` share ``need(k)`` of their
``k`` retained values (five standard deviations below the expected number;
all of them count where the sketch is the whole set), so a class only lists
the rarest ``k - need + 1`` and values that no other class retains are left
out.

The pairs of a list are as many as the square of its length, so they are never
emitted.  First, every class is held against one other: of the lowest classes
of its lists the one it shares most lists with.  These stars are verified by
exact Jaccard on full sets, and what they link is contracted, which takes in
most of a group of copies with one row a copy.  Pairs inside a contracted
component need no comparison; lists that only one component is left on are
done.  Classes of different components that meet on the other lists form a
family, which is cut into blocks of bounded size, every two of which meet in a
unit with their members' full sets.  A unit counts overlaps of the sketches,
takes the overlapping pairs of different components from the largest overlap
down, skips those that its links already join, filters by the union-sketch
estimate and verifies by exact Jaccard.  What it emits is a forest of verified
links; a pair it skips would not have joined anything else, so the components
are those of all links.

Defined results: a text with fewer than ``WIDTH`` words has its whole sequence
as its one shingle; a null text, or one without words, has no shingles and is
linked with nothing; equal texts are linked.  Rows that share an id are one
node, whatever their texts.  A row without an id is returned with
``component_id`` null, kept.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batches, block_units, marked, marks, stage
from .graph import components
from .units import KEYS, over_units, overlaps, sides
from .words import U, blocks, mix, shingles

WIDTH, K, PERCENT = 5, 64, 75


def need(k: int, percent: int = PERCENT, size: int = K) -> int:
    """Common retained values that a pair at the threshold has: of a whole set
    (a sketch that isn't full) that many exactly; otherwise the binomial's
    expected number less five standard deviations."""
    j = percent / 100
    sampled = math.floor(size * j - 5 * math.sqrt(size * j * (1 - j)))
    exact = math.ceil(k * j - 1e-9)
    return max(1, exact if k < size * j else min(exact, sampled))


def sets(col: pa.Array, width: int = WIDTH):
    """Row number and sorted distinct shingle hashes of each text of a column."""
    for w in blocks(col):
        g, ptr = shingles(w.hashes(), w.ptr, width)
        for i in range(w.n):
            yield w.lo + i, np.unique(g[ptr[i]:ptr[i + 1]])


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
             k: int = K) -> DataFrame:
    """``doc_id``, ``n`` (shingles), ``d1``, ``d2`` (a digest of the set) and
    ``sketch`` (the ``k`` smallest hashes, as non-negative numbers)."""

    def run(batches: Batches) -> Batches:
        for b in batches:
            n = np.zeros(b.num_rows, np.int64)
            digest = np.zeros((2, b.num_rows), U)
            kept = [None] * b.num_rows
            for i, u in sets(b.column(1), width):
                n[i] = len(u)
                digest[0, i], digest[1, i] = u.sum(), np.bitwise_xor.reduce(mix(u)) if len(u) else 0
                kept[i] = (u[:k] >> U(1)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n), pa.array(digest[0].view(np.int64)), pa.array(digest[1].view(np.int64)),
                 pa.array(kept, pa.list_(pa.int64()))], names=["doc_id", "n", "d1", "d2", "sketch"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n long, d1 long, d2 long, sketch array<long>")


def _lists(reps: DataFrame, percent: int, k: int) -> DataFrame:
    """``rep``, ``v``: the classes' listed values that another class retains too."""
    values = reps.select("rep", F.explode("sketch").alias("v"))
    shared = values.groupBy("v").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    # a class's retained values that others retain too, rarest first
    own = values.join(shared, "v").groupBy("rep").agg(
        F.sort_array(F.collect_list(F.struct("c", "v"))).alias("vs"))
    table = F.array(*[F.lit(need(s, percent, k) if s else 1) for s in range(k + 1)])
    size = F.size("sketch")
    # k - need + 1 are listed; those that nobody shares are the rarest of them
    listed = size - F.element_at(table, size + 1) + 1 - (size - F.size("vs"))
    return (own.join(reps.select("rep", "sketch"), "rep").withColumn("m", listed).where("m > 0")
            .select("rep", F.explode(F.slice("vs", F.lit(1), F.col("m"))).alias("x"))
            .select("rep", F.col("x.v").alias("v")))


def _listed_sets(docs: DataFrame, lists: DataFrame, width: int) -> DataFrame:
    """``doc_id``, ``shingles`` of the documents that stand for a listed class
    (marked ids only; a few others share a mark with one of them)."""

    def key(batches: Batches) -> Batches:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(mix(b.column(0).to_numpy().view(U)).view(np.int64))], names=["h"])

    bits, shared = marks(stage(lists.select("rep").distinct(), "listed").mapInArrow(key, "h long"))

    def full(batches: Batches) -> Batches:
        for b in batches:
            known = b.filter(b.column(0).is_valid())
            part = known.filter(pa.array(marked(mix(known.column(0).to_numpy().view(U)), bits, shared.value)))
            for lo in range(0, part.num_rows, 512):
                some = part.slice(lo, 512)
                own = pa.array([u.tobytes() for _, u in sets(some.column(1), width)], pa.binary())
                yield pa.RecordBatch.from_arrays([some.column(0), own], names=["doc_id", "shingles"])

    return docs.mapInArrow(full, "doc_id long, shingles binary")


def _rows(full: DataFrame, units: DataFrame) -> DataFrame:
    """The columns of a unit, then ``rep``, ``label`` and its ``shingles``."""
    return full.join(units, full["doc_id"] == units["rep"]).select(*KEYS, "_mine", "rep", "label", "shingles")


def _similar(s: np.ndarray, t: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(s, t, assume_unique=True))
    return 100 * both >= percent * (len(s) + len(t) - both)


def _stars(full_sets: DataFrame, reps: DataFrame, lists: DataFrame, percent: int, block: int = 512,
           heaviest: int = 1 << 20) -> DataFrame:
    """Verified links ``a``, ``b`` of classes with one centre each.  A centre's
    members meet it in chunks of bounded size."""
    low = lists.groupBy("v").agg(F.min("rep").alias("low"))
    sizes = reps.groupBy("rep").agg(F.max("n").alias("n"))
    pairs = lists.join(low, "v").where("rep <> low").groupBy("rep", "low").agg(F.count(F.lit(1)).alias("c"))
    one = pairs.groupBy("rep").agg(F.max(F.struct("c", -F.col("low"))).alias("x")).select(
        "rep", (-F.col("x.col2")).alias("bucket"))
    star = one.join(sizes, "rep").join(sizes.select(F.col("rep").alias("bucket"), F.col("n").alias("m")), "bucket").where(
        100 * F.least("n", "m") >= percent * F.greatest("n", "m"))
    chunks = star.groupBy("bucket").agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / block, F.sum("n") / heaviest)).cast("long").alias("chunks"))
    star = stage(star.join(chunks, "bucket").withColumn("_i", F.pmod(F.xxhash64("rep"), "chunks").cast("int")).select(
        "bucket", "_i", F.lit(1).alias("_mine"), "rep"), "stars")
    centres = star.select("bucket", "_i", F.lit(0).alias("_mine"), F.col("bucket").alias("rep")).distinct()
    units = star.unionByName(centres).withColumn("_j", F.lit(0)).withColumn("label", F.lit(0).cast("long"))
    rows = _rows(full_sets, units)

    def emit(g):
        full = [np.frombuffer(x, U) for x in g["shingles"]]
        centres = [full[i] for i in np.flatnonzero(g["_mine"] == 0)]
        good = [i for i in np.flatnonzero(g["_mine"] == 1) if any(_similar(full[i], c, percent) for c in centres)]
        return [(g["rep"][good], g["bucket"][good])] if good else []

    return over_units(rows, emit, ["a", "b"], "a long, b long")


def _families(lists: DataFrame, stars: DataFrame, reps: DataFrame) -> DataFrame:
    """``rep``, ``bucket`` (its family), ``n`` and ``label`` (its component so
    far) of the classes that share a listed value with another component."""
    comp = components(stars).withColumnsRenamed({"id": "rep", "component_id": "label"})
    labelled = stage(lists.join(comp, "rep", "left").withColumn("label", F.coalesce("label", "rep")), "labelled")
    mixed = labelled.groupBy("v").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.min("rep").alias("low"))
    rest = stage(labelled.join(mixed.where("x <> y").select("v", "low"), "v").select("rep", "label", "low").distinct(), "rest")
    family = components(rest, "rep", "low").withColumnsRenamed({"id": "rep", "component_id": "bucket"})
    sizes = reps.groupBy("rep").agg(F.max("n").alias("n"))
    return family.join(rest.select("rep", "label").distinct(), "rep").join(sizes, "rep")


def _links(full_sets: DataFrame, family: DataFrame, percent: int, k: int, block: int = 1024) -> DataFrame:
    """A forest of verified links (``a``, ``b``) between the components
    (``label``) of each unit of a family (``family``: ``rep``, ``bucket``, ``n``,
    ``label``)."""
    units = block_units(family, "bucket", "rep", block, "n").drop("n")
    rows = _rows(full_sets, units)
    least = np.array([need(s, percent, k) if s else 1 for s in range(k + 1)])
    j = percent / 100
    floor = j - 5 * math.sqrt(j * (1 - j) / k)

    def estimated(x, y):
        """Is the union sketch's share of common values high enough?"""
        _, i, other = np.intersect1d(x, y, assume_unique=True, return_indices=True)
        rank = i + other - np.arange(len(i))  # place in the union's order
        union = len(x) + len(y) - len(i)
        whole = len(x) < k and len(y) < k and union <= k  # a larger union is only sampled
        size = min(k, union)
        return (rank < size).sum() >= (j - 1e-9 if whole else floor) * size

    def emit(g):
        a, b = sides(g)
        same = g["_i"][0] == g["_j"][0]
        full = [np.frombuffer(x, U) for x in g["shingles"]]
        sketch = np.full((len(full), k), -1, np.int64)
        for i, x in enumerate(full):
            sketch[i, :min(k, len(x))] = (x[:k] >> U(1)).view(np.int64)
        n = np.array([len(x) for x in full])
        o = overlaps(sketch[a], sketch[b])
        bar = least[np.minimum(n, k)]
        na, nb = n[a][:, None], n[b][None, :]
        ok = (o >= np.maximum(bar[a][:, None], bar[b][None, :])) & (
            100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))
        _, first, label = np.unique(g["label"], return_index=True, return_inverse=True)
        ok &= label[a][:, None] != label[b][None, :]
        r, c = np.nonzero(np.triu(ok, 1) if same else ok)
        order = np.argsort(-o[r, c], kind="stable")
        parent = first[label].tolist()

        def root(x):
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        found = []
        for x, y in zip(a[r[order]].tolist(), b[c[order]].tolist()):
            p, q = root(x), root(y)
            if p == q:
                continue
            s, t = full[x], full[y]
            if not estimated(s[:k], t[:k]):
                continue
            if _similar(s, t, percent):
                parent[max(p, q)] = min(p, q)
                found.append((x, y))
        if not found:
            return []
        x, y = np.array(found).T
        return [(g["rep"][x], g["rep"][y])]

    return over_units(rows, emit, ["a", "b"], "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
                    width: int = WIDTH, k: int = K, block: int = 1024) -> DataFrame:
    """One row a document: ``doc_id``, ``n_shingles``, ``component_id`` (the
    smallest id reachable over links, its own included) and ``kept``.  A family
    of more than ``block`` classes is cut into blocks."""
    all_docs = stage(sketches(docs, id_col, text_col, width, k), "sketches")
    key = ["n", "d1", "d2"]
    classes = all_docs.where("n > 0 and doc_id is not null")
    reps = stage(classes.groupBy(*key).agg(F.min(F.struct("doc_id", "sketch")).alias("x"))
                 .select(*key, F.col("x.doc_id").alias("rep"), F.col("x.sketch").alias("sketch")), "classes")
    # an id that several rows share ties all their classes together
    of_row = classes.select("doc_id", *key).join(reps.select(*key, "rep"), key).select("doc_id", "rep")
    split = of_row.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("x")).where("b <> x")
    ties = of_row.join(split, "doc_id").select(F.col("rep").alias("a"), "b").where("a <> b").distinct()

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    lists = stage(_lists(reps, percent, k), "lists")
    full = stage(_listed_sets(texts, lists, width), "full-sets")
    stars = stage(_stars(full, reps, lists, percent).unionByName(ties), "star-links")
    family = stage(_families(lists, stars, reps), "families")
    found = components(_links(full, family, percent, k, block).unionByName(stars))

    per_class = reps.join(found.withColumnRenamed("id", "rep"), "rep", "left").select(
        *key, F.coalesce("component_id", "rep").alias("component_id"))
    out = all_docs.select("doc_id", *key).join(per_class, key, "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    own = F.when(F.col("doc_id").isNotNull(), own)
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
