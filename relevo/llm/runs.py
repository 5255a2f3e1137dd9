"""Periodic runs of words (operator 13).

Method: the first phase of Baier's suffix sorter groups the suffixes of a word
sequence by their longest Lyndon prefix.  Groups are taken from the largest
prefix down; a suffix of the group at hand is final, and is appended to the
nearest unfinished suffix on its left, which so moves to a new group just above
its old one.  The lengths at which suffixes become final are the Lyndon array.
It is taken under an order of the words and under the reverse of it.  Every run
holds the Lyndon root of its period at a place where the array of one of the
orders shows it, so each entry is a candidate root; common extensions to the
left and right of two neighbouring roots give the run.

Only runs of at least ``LEAST_PERIODS`` periods (and ``LEAST_WORDS`` words)
count, which allows two exact shortcuts.  Every three neighbouring words of such a
run occur three times in it at least, so a text is cut where three words occur
less often, and only the remaining stretches are sorted.  And such a run
shows its root at three places in a row, at distances of the period.

All of it is done text by text inside a partition: runs do not cross texts, and
a text is one row.  The work on a text is linear but for sorting.

Defined results: words are runs of bytes other than ASCII white space, compared
byte by byte; a null text has no words and no runs; rows that share an id are
texts of their own.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batches

LEAST_WORDS, LEAST_PERIODS = 6, 4


def lyndon_array(s: list[int]) -> list[int]:
    """The length of the longest Lyndon word from every place of ``s``; its
    values are ``0 .. max(s)``, all of which occur."""
    n = len(s)
    members: list[list[int]] = [[] for _ in range(max(s, default=-1) + 1)]
    for i, c in enumerate(s):
        members[c].append(i)
    below = list(range(-1, len(members) - 1))  # the next smaller group
    above = list(range(1, len(members) + 1))
    group = list(s)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))  # unfinished neighbours
    out = [0] * n
    now = len(members) - 1
    while now >= 0:
        grown: dict[int, int] = {}
        for i in members[now]:  # from left to right
            if group[i] != now:
                continue  # it has moved on
            u, r = left[i], right[i]
            out[i] = r - i
            if r < n:
                left[r] = u
            if u >= 0:
                right[u] = r
                grown[u] = grown.get(u, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for u, times in grown.items():
            moved.setdefault((group[u], times), []).append(u)
        # more repeats make a larger prefix; each new group goes right above its old one
        for old, times in sorted(moved, reverse=True):
            new, high = len(members), above[old]
            members.append(moved[old, times])
            for u in members[new]:
                group[u] = new
            below.append(old), above.append(high)
            above[old] = below[high] = new
        now = below[now]
    return out


def common_extension(s: np.ndarray, i: int, j: int) -> int:
    """How many places from ``i < j`` on ``s`` is the same as from ``j`` on."""
    k, step = 0, 16
    while j + k < len(s):
        m = min(step, len(s) - j - k)
        other = s[i + k:i + k + m] != s[j + k:j + k + m]
        if other.any():
            return k + int(other.argmax())
        k, step = k + m, 2 * step
    return k


def stretches(s: np.ndarray, rounds: int = 4) -> list[tuple[int, int]]:
    """The parts ``(start, end)`` of ``s`` that can hold a run: three
    neighbouring words inside one occur at least three times in their part."""
    if len(s) < LEAST_WORDS:
        return []
    three = LEAST_PERIODS - 1
    often = np.bincount(s)[s] > three
    at = np.flatnonzero(often[:-2] & often[1:-1] & often[2:])
    size = int(s.max()) + 1
    least = LEAST_WORDS - 2
    for _ in range(rounds):
        part = np.cumsum(np.r_[True, np.diff(at) != 1]) - 1 if len(at) else at
        held = np.bincount(part)[part] >= least if len(at) else at
        at, part = at[held], part[held]
        if not len(at):
            return []
        key = np.unique(s[at] * size + s[at + 1], return_inverse=True)[1] * size + s[at + 2]
        key = np.unique(key, return_inverse=True)[1] * (int(part[-1]) + 1) + part
        _, where, count = np.unique(key, return_inverse=True, return_counts=True)
        rare = count[where] < three
        if not rare.any():
            break
        at = at[~rare]
    cut = np.flatnonzero(np.diff(at) != 1) + 1
    return [(int(x[0]), int(x[-1]) + 3) for x in np.split(at, cut) if len(x) >= least]


def periodic_parts(s: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of the sequence ``s`` (numbers from
    0) with enough periods and words, by start and period."""
    found = set()
    for lo, hi in stretches(s):
        _, x = np.unique(s[lo:hi], return_inverse=True)
        back, top, n = x[::-1], int(x.max()), len(x)
        for order in (x, top - x):
            p = np.array(lyndon_array(order.tolist()))
            i = np.flatnonzero(np.arange(n) + 3 * p <= n)
            i = i[(p[i + p[i]] == p[i]) & (p[i + 2 * p[i]] == p[i])]
            done: dict[int, int] = {}  # period: where its last run ends
            for a, q in zip(i.tolist(), p[i].tolist()):
                if a + q <= done.get(q, 0):
                    continue
                end = a + q + common_extension(x, a, a + q)
                start = a - common_extension(back, n - a - q, n - a)
                done[q] = end
                if end - start >= max(LEAST_WORDS, LEAST_PERIODS * q):
                    found.add((lo + start, end - start, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside of runs and in the first period of each, joined by a space."""
    if runs:
        kept = np.ones(len(words), bool)
        for start, length, period in runs:
            kept[start + period:start + length] = False
        words = [w for w, k in zip(words, kept.tolist()) if k]
    return b" ".join(words)


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def periodic_runs(docs: DataFrame, keep: list[str], text_col: str = "text", digest: bool = False,
                  most_bytes: int = 1 << 22) -> DataFrame:
    """Columns ``keep`` of ``docs``, then ``runs`` (by start and period: first
    word, words, period), ``n_words`` and ``collapsed``, the text's words without
    the repeats of each run, joined by one space; with ``digest`` only the hex
    SHA-256 of that text comes back, and not the text."""
    m = len(keep)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Batches) -> Batches:
        for b in batches:
            lo, held, runs, sizes, texts = 0, 0, [], [], []
            for k, t in enumerate(b.column(m)):
                words = t.as_buffer().to_pybytes().split() if t.is_valid else []
                number: dict[bytes, int] = {}
                s = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
                got = periodic_parts(s)
                runs.append([{"start": a, "length": n, "period": q} for a, n, q in got])
                sizes.append(len(words))
                rest = collapsed(words, got)
                texts.append(hashlib.sha256(rest).hexdigest() if digest else rest.decode())
                held += len(texts[-1])
                if held > most_bytes or k + 1 == b.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [*(c.slice(lo, len(runs)) for c in b.columns[:m]), pa.array(runs, kind),
                         pa.array(sizes, pa.int64()), pa.array(texts, pa.string())],
                        names=[*(f"c{i}" for i in range(m)), "runs", "n_words", "collapsed"])
                    lo, held, runs, sizes, texts = k + 1, 0, [], [], []

    cols = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)]
    kinds = "".join(f"c{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep))
    out = docs.select(*cols, F.col(f"`{text_col}`").alias("text")).mapInArrow(
        run, f"{kinds}runs {RUNS}, n_words long, collapsed string")
    return out.toDF(*keep, "runs", "n_words", "collapsed")


def strongest(runs):
    """The run of an array (by start and period) with the most periods, the first of equals."""
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, r: F.when(
        r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))


def with_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with a periodic end in the text of every tenth id (by its
    CRC-32 ``h``): from word ``a`` on, the ``p`` words there repeat to the end,
    ``g = h div 10``, ``a = g mod n``, ``p = 1 + (n - a) div (3 + g mod 8)``.
    The words of such a text are joined by one space; others stay as they are."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text_col, F.lit(r"[^\x20\x09-\x0D]+"), 0)
    d = docs.withColumn("_words", F.when(h % 10 == 0, words)).withColumn("_n", F.size("_words").cast("long"))
    d = d.withColumn("_a", F.when(F.col("_n") > 0, g % F.col("_n")))
    rest = F.col("_n") - F.col("_a")
    d = d.withColumn("_p", 1 + F.floor(rest / (3 + g % 8)))
    first = F.slice("_words", F.lit(1), F.col("_a").cast("int"))
    turn = F.slice("_words", (F.col("_a") + 1).cast("int"), F.col("_p").cast("int"))
    turns = F.flatten(F.array_repeat(turn, F.ceil(rest / F.col("_p")).cast("int")))
    text = F.array_join(F.concat(first, F.slice(turns, F.lit(1), rest.cast("int"))), " ")
    text = F.when(F.col("_p").isNotNull(), text).otherwise(F.col(text_col))
    return d.withColumn(text_col, text).select(*docs.columns)
