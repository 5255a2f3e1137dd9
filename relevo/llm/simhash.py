"""Document fingerprints: SimHash and search within a Hamming radius (operator 10).

Method: every distinct word votes with weight ``1 + log2(tf)`` on each signed
bit of its hash; the sign of the sum is the fingerprint's bit.  Fingerprints
within ``radius`` bits of each other are found by permuted block tables: the
bits are cut into ``blocks`` blocks and a table is kept for every choice of
``blocks - radius`` of them, so two fingerprints that differ in at most
``radius`` bits agree on all bits of at least one table's key.

Defined results: a null text counts as empty; an empty text, or one without
words, has the fingerprint of zeros.  Equal texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Batches, block_units, stage
from .words import U, blocks, mix, utf8

BITS = 64
_signs: dict[int, np.ndarray] = {}


def fingerprints(col: pa.Array) -> np.ndarray:
    """The 64-bit fingerprint of every text."""
    out = np.zeros(len(col), U)
    shift = np.arange(BITS, dtype=U)
    for w in blocks(col):
        if not len(w):
            continue
        h = w.hashes()
        words, which = np.unique(h, return_inverse=True)
        # distinct words of each text and how often they occur
        key = w.rows() * len(words) + which
        own, tf = np.unique(key, return_counts=True)
        row, word = own // len(words), own % len(words)
        weight = (1 + np.log2(tf)).astype(np.float32)
        ptr = np.searchsorted(row, np.arange(w.n + 1))
        for a in range(0, w.n, 64):  # a few texts at a time bound the vote table
            b = min(a + 64, w.n)
            lo, hi = ptr[a], ptr[b]
            if lo == hi:
                continue
            for lo2 in range(lo, hi, 1 << 16):
                hi2 = min(lo2 + (1 << 16), hi)
                bits = np.unpackbits(words[word[lo2:hi2]].view(np.uint8).reshape(-1, 8),
                                     axis=1, bitorder="little")
                votes = (bits.astype(np.float32) * 2 - 1) * weight[lo2:hi2, None]
                if lo2 == lo:
                    total = np.zeros((b - a, BITS), np.float64)
                r = row[lo2:hi2] - a
                first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
                total[r[first]] += np.add.reduceat(votes, first, axis=0)
            out[w.lo + a:w.lo + b] = ((total > 0).astype(U) << shift).sum(axis=1)
    return out


def _hex(x: np.ndarray) -> pa.Array:
    return pa.array([f"{v:016x}" for v in x.tolist()], pa.string())


def likeness(a: Column, b: Column) -> Column:
    """Cosine likeness that two fingerprints (as longs) stand for: 1 for equal
    ones, 0 from half of the bits on, where SimHash sees no relation."""
    share = F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))
    return F.greatest(F.lit(0.0), F.cos(F.lit(np.pi) * share))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        share: int = 4) -> DataFrame:
    """Fingerprint every text and its edited text: the last
    ``floor(n_chars / share)`` code points replaced by the first as many (or
    all) of the next document in ascending id (after the last: the first).

    Texts are range-partitioned by id once; a task reads its texts in order.
    Only a partition's last text needs one from elsewhere: the first text of
    the next partition, matched in a table with two rows a partition.  Rows of
    one id follow each other in the order of their texts' hashes; a null id comes
    first.  A single document follows itself.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = slim.withColumn("h", F.xxhash64("text"))
    # the range sampler sees ids and hashes only, never a text
    ordered = ordered.repartitionByRange(F.col("doc_id").asc_nulls_first(), "h").sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "h").drop("h").withColumn("part", F.spark_partition_id())

    names = ["kind", "part", "doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "next_fp", "text"]

    def batch(kind, part, ids, n_chars=None, edited=None, fp=None, texts=None):
        n = len(ids)
        null = lambda t: pa.nulls(n, t)
        if edited is not None:
            raw = [e.encode() for e in edited]
            sha = pa.array([hashlib.sha256(r).hexdigest() for r in raw], pa.string())
            efp = pa.array(fingerprints(pa.array(edited, pa.string())).view(np.int64))
        return pa.RecordBatch.from_arrays([
            pa.array([kind] * n, pa.int32()), pa.array([part] * n, pa.int32()), pa.array(ids, pa.int64()),
            pa.array(n_chars, pa.int64()) if n_chars is not None else null(pa.int64()),
            sha if edited is not None else null(pa.string()),
            pa.array(fp[:n].view(np.int64)) if edited is not None else null(pa.int64()),
            efp if edited is not None else null(pa.int64()),
            pa.array(fp[1:n + 1].view(np.int64)) if edited is not None else null(pa.int64()),
            pa.array(texts, pa.string()) if texts is not None else null(pa.string())], names=names)

    def run(batches: Batches) -> Batches:
        last, part = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            part = b.column(2)[0].as_py()
            for lo in range(0, b.num_rows, 512):
                ids, texts = b.column(0).slice(lo, 512).to_pylist(), b.column(1).slice(lo, 512).to_pylist()
                if last is None:
                    yield batch(0, part, ids[:1], texts=texts[:1])  # the part's first text
                else:
                    ids, texts = [last[0], *ids], [last[1], *texts]
                n = [len(t) for t in texts]
                if len(ids) > 1:
                    cut = [x // share for x in n]
                    edited = [t[:len(t) - c] + nx[:c] for t, nx, c in zip(texts, texts[1:], cut)]
                    fp = fingerprints(pa.array(texts, pa.string()))
                    yield batch(1, part, ids[:-1], n[:-1], edited, fp)
                last = ids[-1], texts[-1]
        if last is not None:
            yield batch(2, part, [last[0]], texts=[last[1]])

    kinds = ("kind int, part int, doc_id long, n_chars long, edited_sha256 string, fp long, "
             "edited_fp long, next_fp long, text string")
    rows = stage(ordered.mapInArrow(run, kinds), "fingerprints")
    # the ends of the partitions: two rows for each, in one small window
    ends = (rows.where("kind <> 1").select("kind", "part", "doc_id", "text")
            .withColumn("next", F.lead("text").over(Window.orderBy("part", "kind"))))
    first = rows.where("kind = 0").orderBy("part").limit(1).select(F.col("text").alias("first"))
    ends = ends.where("kind = 2").join(F.broadcast(first)).select(
        "doc_id", "text", F.coalesce("next", "first").alias("next"))

    def finish(batches: Batches) -> Batches:
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                ids, texts, nxt = (b.column(k).slice(lo, 64).to_pylist() for k in range(3))
                edited = [t[:len(t) - len(t) // share] + x[:len(t) // share] for t, x in zip(texts, nxt)]
                fp = fingerprints(pa.array([y for x in zip(texts, nxt) for y in x], pa.string()))
                out = batch(1, 0, ids, [len(t) for t in texts], edited, np.r_[fp[::2], fp[-1:]])
                yield out.set_column(7, "next_fp", pa.array(fp[1::2].view(np.int64)))

    done = rows.where("kind = 1").unionByName(ends.mapInArrow(finish, kinds))
    return done.select("doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "next_fp")


def tables(radius: int, n_blocks: int) -> list[int]:
    """The key masks of the permuted tables: all choices of blocks to agree on."""
    cuts = np.linspace(0, BITS, n_blocks + 1).astype(int)
    one = [((1 << int(b - a)) - 1) << int(a) for a, b in zip(cuts, cuts[1:])]
    return [sum(x) for x in combinations(one, n_blocks - radius)]


def near_fingerprints(fps: DataFrame, radius: int = 3, n_blocks: int = 5, block: int = 2048) -> DataFrame:
    """For each distinct fingerprint (column ``fp long``): ``n_near``, how many
    other distinct fingerprints lie within ``radius`` bits, and ``first_near``,
    the smallest fingerprint of them and itself.

    Fingerprints of a table that share a key meet in units of bounded size (a
    hot key is cut into blocks, every two of which meet in a unit).  A pair is
    counted in the first table that holds it, so nothing is emitted per pair:
    a unit sends one row a fingerprint.
    """
    masks = np.array(tables(radius, n_blocks), dtype=U)
    signed = [int(m) - (1 << 64) if m >= 1 << 63 else int(m) for m in masks.tolist()]
    own = fps.select("fp").where("fp is not null").distinct()
    keys = F.explode(F.array(*[F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k"))
                               for k, m in enumerate(signed)]))
    members = own.withColumn("x", keys).select("fp", F.col("x.t").alias("t"),
                                               F.xxhash64("x.t", "x.k").alias("bucket"))
    units = block_units(members, "bucket", "fp", block)
    units = units.repartition("bucket", "_i", "_j").sortWithinPartitions("bucket", "_i", "_j")

    def emit(g):
        t, i, j = g["t"][0], g["_i"][0], g["_j"][0]
        a = g["fp"][g["_mine"] == i].view(U)
        b = g["fp"][g["_mine"] == j].view(U)
        na, nb = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        la, lb = a.view(np.int64).copy(), b.view(np.int64).copy()
        for s in range(0, len(a), 256):
            x = a[s:s + 256, None] ^ b[None, :]
            near = (np.bitwise_count(x) <= radius) & (x != 0) & ((x & masks[t]) == 0)
            for m in masks[:t]:
                near &= (x & m) != 0
            na[s:s + 256] += near.sum(axis=1)
            nb += near.sum(axis=0)
            big = np.iinfo(np.int64).max
            la[s:s + 256] = np.minimum(la[s:s + 256], np.where(near, b.view(np.int64)[None, :], big).min(axis=1, initial=big))
            lb = np.minimum(lb, np.where(near, a[s:s + 256].view(np.int64)[:, None], big).min(axis=0, initial=big))
        hit = na > 0
        out = [(a.view(np.int64)[hit], na[hit], la[hit])]
        if i != j:
            hit = nb > 0
            out.append((b.view(np.int64)[hit], nb[hit], lb[hit]))
        return out

    found = units.select("bucket", "_i", "_j", "_mine", "t", "fp").mapInArrow(
        groups(["bucket", "_i", "_j"], emit, ["fp", "n", "low"]), "fp long, n long, low long")
    counts = found.groupBy("fp").agg(F.sum("n").alias("n_near"), F.min("low").alias("first_near"))
    return own.join(counts, "fp", "left").select(
        "fp", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.least(F.coalesce("first_near", "fp"), "fp").alias("first_near"))


def groups(keys: list[str], emit, names: list[str]):
    """A ``mapInArrow`` function over sorted partitions: gathers the rows of
    one unit (bounded by construction) as numpy columns and calls ``emit``,
    which returns parts of output columns."""

    def run(batches: Batches) -> Batches:
        held: list[pa.RecordBatch] = []

        def flush(end: bool):
            t = pa.Table.from_batches(held).combine_chunks()
            cols = {n: t[n].to_numpy(zero_copy_only=False) for n in t.column_names}
            change = np.zeros(len(t), bool)
            for k in keys:
                change[1:] |= cols[k][1:] != cols[k][:-1]
            cuts = np.r_[0, np.flatnonzero(change), len(t)]
            last = len(cuts) - 1 if end else len(cuts) - 2
            parts = []
            for a, b in zip(cuts[:last], cuts[1:last + 1]):
                if b > a:
                    parts += emit({n: c[a:b] for n, c in cols.items()})
            held.clear()
            if not end:
                rest = t.slice(int(cuts[-2]))
                held.extend(rest.to_batches())
            return parts

        def batch(parts):
            cols = [np.concatenate([p[k] for p in parts]) for k in range(len(names))]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=names)

        for b in batches:
            if b.num_rows:
                held.append(b)
                parts = flush(False)
                if parts:
                    yield batch(parts)
        if held:
            parts = flush(True)
            if parts:
                yield batch(parts)

    return run
