"""Toxicity by maximum-scoring segments (operator 9).

Method: each word (a run of letters, ``A-Z`` lower-cased) and each of its
first ``STEMS`` bytes has a log-odds score with an informative Dirichlet prior
(toxic against other labelled texts, prior from both), shrunk by its own
uncertainty; a token takes the strongest of its word's and stems' scores,
moved so that clean text scores below 0 on average.  One
linear scan finds every maximal scoring segment of a text; a segment is
significant where chance would give its score less than ``max_expect`` times
in a text of that length, by the extreme-value law whose rate solves
``E[exp(rate * score)] = 1`` over clean words.  The strongest segment's
log-expectation and the sum over significant segments go through a logistic
curve fitted on labelled texts that gave no counts.

Counts are kept in ``2**BITS`` hashed buckets, so the model has a fixed size.
It is fitted on a sample of at most about ``sample`` labelled texts (a
documented bound).  Defined results: a null or empty text gets the score of a
text without segments; texts with several labels count as toxic if one says
so; without labels of both kinds every score is 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Batches, collect_table, summed_tables
from .words import U, Words, blocks

BITS = 21
STEMS = (4, 6)
_GAP = np.ones(256, bool)  # whatever is no letter parts words
_GAP[65:91] = _GAP[97:123] = _GAP[128:] = False
_BINS, _TOP = 2048, 12.0


@dataclass
class ToxicityModel:
    score: np.ndarray  # by bucket
    drift: float       # taken off every token
    rate: float        # of the extreme-value law
    scale: float
    max_expect: float
    curve: np.ndarray  # logistic: offset, strongest segment, sum of segments


def _buckets(w: Words) -> list[np.ndarray]:
    return [(h >> U(64 - BITS)).astype(np.int64) for h in w.stems(STEMS)]


def _strongest(table: np.ndarray, w: Words) -> np.ndarray:
    """Of each token's word and stems, the score that is largest in size."""
    best, *others = (table[b] for b in _buckets(w))
    for x in others:
        best = np.where(np.abs(x) > np.abs(best), x, best)
    return best.astype(np.float64)


def _texts(col: pa.Array):
    return blocks(col, space=_GAP)


def segments(x: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(start, end, score)`` of a score series,
    in one pass (Ruzzo and Tompa).  Runs of one sign are joined first: a
    maximal segment never starts or ends inside a run."""
    if not len(x) or not (x > 0).any():
        return []
    up = x > 0
    edge = np.flatnonzero(np.r_[True, up[1:] != up[:-1]])
    total = np.r_[0.0, np.cumsum(x)]
    ends = np.r_[edge[1:], len(x)]
    pos = up[edge]
    held: list[list] = []  # start, end, sum before, sum after
    for a, b, l, r in zip(edge[pos].tolist(), ends[pos].tolist(), total[edge[pos]].tolist(),
                          total[ends[pos]].tolist()):
        new = [a, b, l, r]
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= new[2]:
                # a stretch whose left sum is not lower can't be extended to the left
                j = held[j][4]
            if j < 0 or held[j][3] >= new[3]:
                held.append([*new, j])
                break
            new = [held[j][0], new[1], held[j][2], new[3]]
            del held[j:]
    return [(a, b, r - l) for a, b, l, r, _ in held]


def features(model: ToxicityModel, score: np.ndarray) -> tuple[float, float, list]:
    """Log-expectation of the strongest segment, sum over the significant ones
    (both 0 at least), and these segments."""
    found = segments(score)
    if not found:
        return 0.0, 0.0, []
    n = max(len(score), 1)
    strength = [model.rate * s - np.log(model.scale * n) for _, _, s in found]
    good = [(a, b, e) for (a, b, _), e in zip(found, strength) if e > -np.log(model.max_expect)]
    return max(0.0, max(strength)), float(sum(e for _, _, e in good)), good


def _log_odds(counts: np.ndarray, prior: float) -> np.ndarray:
    """Shrunk log-odds by bucket from counts[2, buckets] (other, toxic)."""
    c0, c1 = counts.astype(np.float64)
    both = c0 + c1
    a = prior * both / max(both.sum(), 1)
    n0, n1, a0 = c0.sum(), c1.sum(), a.sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        delta = (np.log((c1 + a) / (n1 + a0 - c1 - a)) - np.log((c0 + a) / (n0 + a0 - c0 - a)))
        z2 = delta ** 2 / (1 / (c1 + a) + 1 / (c0 + a))
    return np.where(both > 0, delta * z2 / (z2 + 4), 0.0).astype(np.float32)  # little evidence: near 0


def _drift_and_rate(clean: np.ndarray) -> tuple[float, float]:
    """From a histogram of clean tokens' scores: what to take off a score, and
    the rate at which ``E[exp(rate * score)] = 1`` after that."""
    x = (np.arange(_BINS) + 0.5) / _BINS * 2 * _TOP - _TOP
    p = clean / max(clean.sum(), 1)
    centre = float((p * x).sum())
    drift = centre + max(0.5 * float(np.sqrt((p * (x - centre) ** 2).sum())), 0.05)
    x = x - drift
    mean = lambda t: float((p * np.exp(np.minimum(t * x, 500))).sum())
    lo, hi = 1e-6, 1.0
    while mean(hi) < 1 and hi < 1e3:
        hi *= 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if mean(mid) < 1 else (lo, mid)
    return drift, lo


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Newton steps for a two-feature logistic curve."""
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), g)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", sample: int = 20_000, prior: float = 1000.0,
        max_expect: float = 1e-3) -> ToxicityModel | None:
    """Fit on rows of ``labels`` where ``learn`` (over ``id_col``) holds."""
    known = labels.select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("y"), learn.alias("ok")).where(
        "ok and i is not null and y in (0, 1)").groupBy("i").agg(F.max("y").alias("y"))
    n = known.count()
    if not n:
        return None
    # drawn by the hash of the id at a rate that fits the bound: so small that it may be broadcast
    drawn = known.where(F.pmod(F.xxhash64("i"), F.lit(1 << 30)) < int((1 << 30) * min(1, sample / n)))
    drawn = drawn.withColumn("part", F.pmod(F.xxhash64("i", F.lit(5)), F.lit(2)).cast("int"))
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("text")).join(
        F.broadcast(drawn), "i").select("text", "y", "part")

    def tokens(b: pa.RecordBatch, label: int, part: int):
        y, of = b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False)
        for w in _texts(b.column(0)):
            row = w.rows() + w.lo
            yield w, (y[row] == label) & (of[row] == part)

    def count(b: pa.RecordBatch, table: np.ndarray) -> None:
        for label in (0, 1):
            for w, use in tokens(b, label, 0):
                for k in _buckets(w):
                    np.add.at(table[label], k[use], 1)

    def clean(b: pa.RecordBatch, table: np.ndarray) -> None:
        for w, use in tokens(b, 0, 1):
            x = np.clip((_strongest(odds.value, w)[use] + _TOP) / (2 * _TOP), 0, 1 - 1e-9)
            table += np.bincount((x * _BINS).astype(np.int64), minlength=_BINS)

    sc, shape = docs.sparkSession.sparkContext, (2, 1 << BITS)
    odds = sc.broadcast(_log_odds(collect_table(summed_tables(rows, count, shape), shape), prior))
    drift, rate = _drift_and_rate(collect_table(summed_tables(rows, clean, (_BINS,)), (_BINS,)))
    model = ToxicityModel(odds.value, drift, rate, 0.1, max_expect, np.zeros(3))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def feature_rows(batches: Batches) -> Batches:
        for b in batches:
            f = _features(shared.value, b.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(f[:, 0]), pa.array(f[:, 1]), b.column(1)],
                                             names=["a", "b", "y"])

    # three numbers a text of the bounded sample
    got = rows.where("part = 1").mapInArrow(feature_rows, "a double, b double, y int").toPandas()
    x, y = got[["a", "b"]].to_numpy(float), got["y"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        return None
    model.curve = _logistic(np.log1p(x), y)
    return model


def _features(model: ToxicityModel, col: pa.Array) -> np.ndarray:
    out = np.zeros((len(col), 2))
    for w in _texts(col):
        s = _strongest(model.score, w) - model.drift
        for i in range(w.n):
            out[w.lo + i] = features(model, s[w.ptr[i]:w.ptr[i + 1]])[:2]
    return out


def score_documents(docs: DataFrame, model: ToxicityModel | None, text_col: str = "text",
                    keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` (default: all), then ``score`` (0 to 1) and
    ``passages``: the significant segments as structs of code-point offsets
    ``start``, ``end`` and their ``strength`` (minus the log of the expected
    number).  Only the text is read."""
    keep = docs.columns if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast(model)
    m = len(keep)
    at = keep.index(text_col) if text_col in keep else m  # the text goes over once
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("strength", pa.float64())]))

    def run(batches: Batches) -> Batches:
        model = shared.value
        for b in batches:
            score, passages = np.zeros(b.num_rows), [[]] * b.num_rows
            for w in _texts(b.column(at)) if model is not None else ():
                s = _strongest(model.score, w) - model.drift
                for i in range(w.n):
                    lo, hi = w.ptr[i], w.ptr[i + 1]
                    x, y, good = features(model, s[lo:hi])
                    z = model.curve @ np.array([1, np.log1p(x), np.log1p(y)])
                    score[w.lo + i] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                    if good:
                        a, e = w.start[[lo + g[0] for g in good]], w.end[[lo + g[1] - 1 for g in good]]
                        raw = w.data[w.offs[i]:w.offs[i + 1]].tobytes()
                        place = lambda p: len(raw[:p - w.offs[i]].decode("utf-8", "ignore"))  # noqa: B023, E731
                        passages[w.lo + i] = [{"start": place(p), "end": place(q), "strength": g[2]}
                                              for p, q, g in zip(a.tolist(), e.tolist(), good)]
            yield pa.RecordBatch.from_arrays(
                [b.column(k) for k in range(m)] + [pa.array(score), pa.array(passages, kind)],
                names=[f"c{k}" for k in range(m)] + ["score", "passages"])

    cols = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(keep)]
    kinds = ", ".join(f"c{k} {docs.schema[c].dataType.simpleString()}" for k, c in enumerate(keep))
    schema = (kinds + ", " if kinds else "") + "score double, passages array<struct<start:long,end:long,strength:double>>"
    cols += [F.col(f"`{text_col}`").alias("text")] if at == m else []
    out = docs.select(*cols).mapInArrow(run, schema)
    return out.toDF(*keep, "score", "passages")
