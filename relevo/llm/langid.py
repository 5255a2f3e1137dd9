"""Language ID by nearest centroids (operator 6).

Method: a text is a TF-IDF vector of hashed byte n-grams (1 to 4 bytes, case
folded, everything but letters folded into one boundary), scaled to length 1.
Each language has several centroids, clustered by spherical k-means, and a
text takes the language of the centroid with the largest cosine.  Where even
that cosine is below a share of what the language's own texts reach
(``reject_share`` of their lowest quantile), the text is rejected.

Document frequencies come from every learnable text.  The centroids come from
a sample of at most about ``sample`` texts a language (documented bound).
Defined results: a null text or one without a letter is ``und`` with score 0
and rejected; with nothing to learn from, every text is.  A predicted language
depends on the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Batches, collect_table, summed_tables
from .words import BLOCK, LOWER, U, mix, utf8

DIMS = 1 << 13
GRAMS = (1, 2, 3, 4)
_LETTER = np.zeros(256, np.uint64)
for _b in range(256):
    if 97 <= LOWER[_b] <= 122 or _b >= 0x80:
        _LETTER[_b] = int(LOWER[_b])
_letter = regex.compile(r"\p{L}").search


def vectors(col: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Raw n-gram counts, as ``(first row, counts[texts, DIMS])`` blocks."""
    data, offs = utf8(col)
    n = len(offs) - 1
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + BLOCK // 2, "right")) - 1
        hi = min(max(hi, lo + 1), n, lo + 256)
        code = _LETTER[data[offs[lo]:offs[hi]]]
        at = offs[lo:hi + 1] - offs[lo]
        counts = np.zeros((hi - lo, DIMS), np.float32)
        gram = np.zeros(len(code), np.uint64)
        for g in GRAMS:
            if len(code) < g:
                break
            gram = gram[:len(code) - g + 1] * U(256) + code[g - 1:] if g > 1 else code.copy()
            feature = (mix(gram + U(g << 40)) % U(DIMS - 1)).astype(np.int64) + 1
            feature[gram == 0] = 0  # only boundaries: not counted
            for i in range(hi - lo):
                a, b = at[i], at[i + 1] - g + 1
                if b > a:
                    counts[i] += np.bincount(feature[a:b], minlength=DIMS)
        counts[:, 0] = 0
        yield lo, counts
        lo = hi


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(length > 0, length, 1)


def tfidf(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return _unit(np.log1p(counts) * idf)


def _centroids(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means, started from texts spread by farthest-first choice."""
    pick = [int(np.argmax(x @ x.mean(axis=0)))]
    best = x @ x[pick[0]]
    while len(pick) < min(k, len(x)):
        pick.append(int(np.argmin(best)))
        best = np.maximum(best, x @ x[pick[-1]])
    c = x[pick]
    for _ in range(rounds):
        near = np.argmax(x @ c.T, axis=1)
        c = _unit(np.stack([x[near == j].sum(axis=0) if (near == j).any() else c[j]
                            for j in range(len(c))]))
    return c


class LanguageModel:
    """Learned state: ``idf`` and the centroids with their languages and floors."""

    def __init__(self, idf: np.ndarray, langs: list[str], centroids: np.ndarray, floors: np.ndarray):
        self.idf, self.langs, self.centroids, self.floors = idf, langs, centroids, floors


def fit(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", sample: int = 600, k: int = 4, reject_share: float = 0.3) -> LanguageModel:
    """Learn from the rows where ``learn`` holds and text and language are given."""
    rows = docs.where(learn).select(F.col(id_col).alias("i"), F.col(text_col).alias("text"),
                                    F.col(lang_col).cast("string").alias("lang")).where(
        "text is not null and lang is not null")

    def count(b: pa.RecordBatch, table: np.ndarray) -> None:
        for _, c in vectors(b.column(0)):
            table[:DIMS] += (c > 0).sum(axis=0)
        table[DIMS] += b.num_rows

    df = collect_table(summed_tables(rows.select("text"), count, (DIMS + 1,)), (DIMS + 1,))
    idf = (np.log((1 + df[DIMS]) / (1 + df[:DIMS])) + 1).astype(np.float32)

    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    # one row a language; a text is drawn by the hash of its id, at a rate that fits the bound
    draw = F.pmod(F.xxhash64("i"), F.lit(1 << 30)) < F.floor(F.lit(float(sample << 30)) / F.col("n"))
    drawn = rows.join(F.broadcast(sizes), "lang").where(draw).select("lang", "text")

    def cluster(t: pa.Table) -> pa.Table:
        x = np.concatenate([tfidf(c, idf) for _, c in vectors(t["text"])])
        x = x[(x * x).sum(axis=1) > 0]
        if not len(x):
            return pa.table({"lang": pa.array([], pa.string()), "centroid": pa.array([], pa.binary()),
                             "floor": pa.array([], pa.float64())})
        c = _centroids(x, k)
        near = (x @ c.T).max(axis=1)
        floor = float(np.quantile(near, 0.01)) * reject_share
        lang = t["lang"][0].as_py()
        return pa.table({"lang": [lang] * len(c), "centroid": [r.astype(np.float32).tobytes() for r in c],
                         "floor": [floor] * len(c)})

    got = drawn.groupBy("lang").applyInArrow(cluster, "lang string, centroid binary, floor double").collect()
    got.sort(key=lambda r: (r.lang, r.centroid))  # at most k rows a language
    c = np.stack([np.frombuffer(r.centroid, np.float32) for r in got]) if got else np.zeros((0, DIMS), np.float32)
    return LanguageModel(idf, [r.lang for r in got], c, np.array([r.floor for r in got]))


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text",
            keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` (default: all), then ``lang_pred``,
    ``score`` (the cosine, 0 to 1) and ``rejected``.  Only the text is read."""
    keep = docs.columns if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast(model)
    m = len(keep)
    at = keep.index(text_col) if text_col in keep else m  # the text goes over once

    def run(batches: Batches) -> Batches:
        model = shared.value
        for b in batches:
            lang, score, bad = [], [], []
            texts = b.column(at)
            for lo, c in vectors(texts):
                ascii_letters = c.sum(axis=1) > 0
                if model.langs:
                    cos = np.clip(tfidf(c, model.idf) @ model.centroids.T, 0, 1).astype(np.float64)
                    top = cos.argmax(axis=1)
                for i in range(len(c)):
                    if not model.langs or not ascii_letters[i] or not _letter(texts[lo + i].as_py()):
                        lang.append("und"), score.append(0.0), bad.append(True)
                        continue
                    lang.append(model.langs[top[i]])
                    score.append(float(cos[i, top[i]]))
                    bad.append(bool(cos[i, top[i]] < model.floors[top[i]]))
            yield pa.RecordBatch.from_arrays(
                [b.column(k) for k in range(m)] + [pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                                                   pa.array(bad, pa.bool_())],
                names=[f"c{k}" for k in range(m)] + ["lang_pred", "score", "rejected"])

    cols = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(keep)]
    kinds = ", ".join(f"c{k} {docs.schema[c].dataType.simpleString()}" for k, c in enumerate(keep))
    schema = (kinds + ", " if kinds else "") + "lang_pred string, score double, rejected boolean"
    cols += [F.col(f"`{text_col}`").alias("text")] if at == m else []
    out = docs.select(*cols).mapInArrow(run, schema)
    return out.toDF(*keep, "lang_pred", "score", "rejected")
