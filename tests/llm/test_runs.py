"""Operator 13: Lyndon arrays and runs against their definitions."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from test_queries import docs_of, trap_rows, write

from conftest import SF_SMALL
from relevo.llm import runs as R
from relevo.llm.queries import QUERIES


def lyndon(s):
    out = []
    for i in range(len(s)):
        j = i + 1
        while j < len(s) and s[i:] < s[j:]:
            j += 1
        out.append(j - i)
    return out


def all_runs(words):
    """Every run by comparing the words with themselves, shifted by each period."""
    number, found, covered = {}, [], set()
    s = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    n = len(s)
    for q in range(1, n // 4 + 1):
        same = np.r_[False, s[:-q] == s[q:], False]
        edge = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            length = b - a + q
            # a period that a smaller one divides shows the same stretch again
            if length >= max(6, 4 * q) and not any((a, length, p) in covered for p in range(1, q) if q % p == 0):
                found.append((a, length, q))
                covered.add((a, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def sequences():
    rng = random.Random(5)
    for _ in range(1500):
        k = rng.randint(1, 4)
        s = [rng.randrange(k) for _ in range(rng.randint(0, 40))]
        u = [rng.randrange(k) for _ in range(rng.randint(1, 5))]
        at = rng.randint(0, len(s))
        s = s[:at] + u * rng.randint(0, 7) + u[:rng.randint(0, len(u))] + s[at:]
        number = {}
        yield [number.setdefault(x, len(number)) for x in s]


def test_lyndon_arrays_under_both_orders():
    for s in sequences():
        assert R.lyndon_array(s) == lyndon(s)
        turned = [max(s) - x for x in s]
        assert R.lyndon_array(turned) == lyndon(turned)


def test_runs_of_short_sequences():
    for s in sequences():
        assert R.periodic_parts(np.array(s, np.int64)) == all_runs(s)


@pytest.mark.parametrize("s, want", [
    ([0] * 50_000 + [1], [(0, 50_000, 1)]), ([1] * 50_000 + [0], [(0, 50_000, 1)]), ([0, 1] * 25_000, [(0, 50_000, 2)]),
    (list(range(50_000)), []), ([0, 1, 0, 1, 0, 2] * 4, [(0, 24, 6)]), ([0] * 5, []), ([0] * 6, [(0, 6, 1)]),
    ([0, 1] * 3 + [0], []), ([0, 1] * 4, [(0, 8, 2)]), ([0] * 6 + [1] + [0] * 6, [(0, 6, 1), (7, 6, 1)])])
def test_long_and_edge_sequences(s, want):
    assert R.periodic_parts(np.array(s, np.int64)) == want


def expected(i, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(i).encode()) if i is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
    found = all_runs(words)
    gone = {k for a, length, q in found for k in range(a + q, a + length)}
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    digest = hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()).hexdigest()
    rest = hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in gone)).hexdigest()
    one = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (i, len(found), *one, digest, rest)


@pytest.mark.parametrize("where", ["traps", "given"])
def test_query_by_brute_force(spark, tmp_path, where):
    rows = trap_rows() + [(k, "a b c d e f " * 3 + "Tail " * (k % 9), "en", "z", 0) for k in range(100, 160)]
    sf = SF_SMALL if where == "given" else write(spark, tmp_path, rows)
    got = [(r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)
           for r in QUERIES["op13_periodic_runs"](spark, sf).collect()]
    want = [expected(i, t) for i, t in docs_of(spark, sf)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(r[1] > 0 for r in got) > 5


def test_operator_returns_spans_and_texts(spark):
    d = spark.createDataFrame([(1, "x A b A b A b A b y", "k"), (2, None, "k")], "doc_id long, text string, runs string")
    one, two = R.periodic_runs(d, ["doc_id"]).orderBy("doc_id").collect()
    assert [tuple(r) for r in one.runs] == [(1, 8, 2)] and one.collapsed == "x A b y" and one.n_words == 10
    assert two.runs == [] and two.collapsed == "" and two.n_words == 0
