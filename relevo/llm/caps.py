"""Embedding near-duplicates by spherical-cap filters (operator 3).

Method: filter directions are a structured random product code: the space is
turned by a random rotation and cut into ``m`` parts, each with its own random
unit code words; a direction is one word of each part.  A vector passes a
filter where its inner product with the direction reaches ``alpha``, and all
the filters it passes are decoded part by part, dropping every prefix that can
no longer reach ``alpha``.  Vectors are joined on filters and cosines verified
in double precision.  There are about as many filters as different vectors,
and ``alpha`` lets a random vector pass about ``passes`` of them; two vectors
with a cosine of 0.95 miss each other with a chance well below 1 in 1000.

Equal vectors are one class with a multiplicity.  A filter with many vectors
is cut into blocks, every two of which meet in a unit.  A unit emits a count
for each vector and a spanning forest of its links, never the pairs; a pair is
counted at its first common filter only.

Defined results: a vector that is null, empty, zero, or holds a null or
non-finite component is linked with nothing; vectors of different lengths are
not linked.  A row without an id is returned unlinked, with a null component.
Rows that share an id are one node; each row counts as a vector.
"""

from __future__ import annotations

from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Batches, block_units, stage
from .graph import components
from .units import forest, over_units, overlaps, sides


def code_size(n: int) -> tuple[int, int]:
    """Parts of the code and words of each, for about ``n`` directions."""
    bits = max(8, int(np.ceil(np.log2(max(n, 2)))))
    m = max(2, -(-bits // 8))
    return m, round(2 ** (bits / m))


@lru_cache(maxsize=8)
def code(dim: int, m: int, words: int, seed: int = 5):
    """A random rotation and, for each part, its slice and its code words."""
    rng = np.random.default_rng([seed, dim, m, words])
    rotation, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
    cuts = np.linspace(0, dim, min(m, dim) + 1).astype(int)
    parts = []
    for a, b in zip(cuts, cuts[1:]):
        c = rng.standard_normal((words, b - a))
        parts.append((slice(a, b), c / np.linalg.norm(c, axis=1, keepdims=True) / np.sqrt(len(cuts) - 1)))
    return rotation, parts


def decode(x: np.ndarray, m: int, words: int, passes: int) -> list[np.ndarray]:
    """The filters that each row (a unit vector) passes.  Where the parts of a
    vector are so uneven that it passes fewer than half of ``passes``, its own
    bar is lowered by tenths until it does."""
    dim = x.shape[1]
    rotation, parts = code(dim, m, words)
    alpha = NormalDist().inv_cdf(1 - min(0.5, passes / words ** len(parts))) / np.sqrt(dim)
    turned = x @ rotation
    products = [turned[:, s] @ c.T for s, c in parts]
    best = np.stack([p.max(axis=1) for p in products], axis=1)
    least = min(passes // 2, words ** len(parts))
    out = []
    for i in range(len(x)):
        bar = min(alpha, best[i].sum())
        while True:
            ids, sums = np.zeros(1, np.int64), np.zeros(1)
            for k, p in enumerate(products):
                total = sums[:, None] + p[i][None, :]
                r, c = np.nonzero(total + best[i, k + 1:].sum() >= bar - 1e-12)
                ids, sums = ids[r] * words + c, total[r, c]
            if len(ids) >= least:
                break
            bar -= 0.1 * abs(bar) + 1e-3
        out.append(ids)
    return out


def _vectors(col: pa.Array, kind: type) -> list[bytes | None]:
    """Raw bytes in the column's own precision (null where the vector is void)."""
    raw = []
    for v in col:
        x = v.values if v.is_valid else None
        if x is None or not len(x) or x.null_count:
            raw.append(None)
            continue
        x = x.to_numpy(zero_copy_only=False).astype(kind) + kind(0)  # no negative zero
        raw.append(x.tobytes() if np.isfinite(x).all() and x.any() else None)
    return raw


def _unit(raw: list[bytes], kind: type) -> np.ndarray:
    """Rows of unit length, in double precision."""
    x = np.stack([np.frombuffer(r, kind) for r in raw]).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def similar_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = 0.95, passes: int = 16, block: int = 1024) -> DataFrame:
    """One row a vector: ``vec_id``, ``n_links`` (other vectors linked
    directly), ``component_id`` (the smallest id reachable), ``kept``."""

    kind = np.float32 if vectors.schema[vector_col].dataType.elementType == T.FloatType() else np.float64

    def read(batches: Batches) -> Batches:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_vectors(b.column(1), kind), pa.binary())],
                                             names=["vec_id", "raw"])

    rows = stage(vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
                 .mapInArrow(read, "vec_id long, raw binary"), "vectors")
    valid = rows.where("raw is not null and vec_id is not null")
    reps = stage(valid.groupBy("raw").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")
    m, words = code_size(reps.count())

    def filters(batches: Batches) -> Batches:
        for b in batches:
            raw = b.column(0).to_pylist()
            found: list = [None] * len(raw)
            for size in set(map(len, raw)):
                at = [i for i, r in enumerate(raw) if len(r) == size]
                for lo in range(0, len(at), 512):
                    part = at[lo:lo + 512]
                    for i, ids in zip(part, decode(_unit([raw[i] for i in part], kind), m, words, passes)):
                        found[i] = ids
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.list_(pa.int64()))],
                                             names=["raw", "rep", "copies", "filters"])

    passed = reps.select("raw", "rep", "copies").mapInArrow(
        filters, "raw binary, rep long, copies long, filters array<long>")
    members = passed.withColumn("filter", F.explode("filters")).withColumn(
        "bucket", F.xxhash64(F.octet_length("raw"), "filter"))
    members = members.withColumn("before", F.filter("filters", lambda f: f < F.col("filter"))).select(
        "bucket", "rep", "copies", "raw", "before")
    units = block_units(members, "bucket", "rep", block)

    def emit(g):
        a, b = sides(g)
        same = g["_i"][0] == g["_j"][0]
        if not len(a) or not len(b):
            return []
        x = _unit(list(g["raw"][a]), kind)
        y = x if same else _unit(list(g["raw"][b]), kind)
        near = x @ y.T >= threshold
        if same:
            np.fill_diagonal(near, False)
        if not near.any():
            return []
        ra, rb = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        near = near[np.ix_(ra, rb)]
        a, b = a[ra], b[rb]

        def padded(ix):
            own = [g["before"][i] for i in ix]
            out = np.full((len(own), max(1, max(map(len, own)))), -1, np.int64)
            for r, f in enumerate(own):
                out[r, :len(f)] = f
            return out

        near &= overlaps(padded(a), padded(b)) == 0  # the pair's first common filter
        if not near.any():
            return []
        rows_ = [(g["rep"][a], g["rep"][a], near @ g["copies"][b])]  # a count: the vector itself twice
        if not same:
            rows_.append((g["rep"][b], g["rep"][b], near.T @ g["copies"][a]))
        r, c = forest(near.astype(np.float32), bool(same))
        rows_.append((g["rep"][a[r]], g["rep"][b[c]], np.zeros(len(r), np.int64)))
        return rows_

    found = stage(over_units(units, emit, ["a", "b", "n"], "a long, b long, n long"), "caps")
    links = found.where("a = b").groupBy("a").agg(F.sum("n").alias("linked"))
    edges = found.where("a <> b").select("a", "b")
    # an id that several rows share ties all their classes together
    of_row = valid.join(reps, "raw").select("vec_id", "rep")
    split = of_row.groupBy("vec_id").agg(F.min("rep").alias("b"), F.max("rep").alias("x")).where("b <> x")
    ties = of_row.join(split, "vec_id").select(F.col("rep").alias("a"), "b").where("a <> b").distinct()
    comp = components(edges.unionByName(ties)).withColumnRenamed("id", "rep")
    per_class = reps.join(links.withColumnRenamed("a", "rep"), "rep", "left").join(comp, "rep", "left").select(
        "raw", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component_id", "rep").alias("component_id"))
    out = rows.join(per_class, "raw", "left").select(
        "vec_id", F.coalesce(F.when(F.col("vec_id").isNotNull(), F.col("n_links")), F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
