"""Helpers without Spark: words, shingles, merges, segments, filters."""

import base64
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from relevo.llm import bpe, caps, lm, simhash, toxicity
from relevo.llm.units import forest, overlaps
from relevo.llm.words import blocks, shingles

TEXTS = st.lists(st.text(alphabet="aAbß é\n\t  x", max_size=40), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_are_those_of_a_split(texts, size):
    seen = {}
    for w in blocks(pa.array(texts, pa.string()), size):
        h = w.hashes()
        for i in range(w.n):
            want = texts[w.lo + i].encode().lower().split()
            own = h[w.ptr[i]:w.ptr[i + 1]].tolist()
            assert len(own) == len(want)
            for x, y in zip(own, want):
                assert seen.setdefault(y, x) == x
    assert len(set(seen.values())) == len(seen)


def test_null_and_sliced_columns():
    col = pa.array(["q", None, "a b", "", "c"]).slice(1)
    assert [int(n) for w in blocks(col) for n in np.diff(w.ptr)] == [0, 2, 0, 1]


def test_shingles_of_short_and_long_texts():
    col = pa.array(["a b c d e f", "a b", "a b c", "", "a b c d e"])
    w = next(blocks(col))
    g, ptr = shingles(w.hashes(), w.ptr)
    assert np.diff(ptr).tolist() == [2, 1, 1, 0, 1]
    assert g[0] == g[ptr[4]] and len(set(g.tolist())) == 4


RANKS = bpe.read_ranks(open(P.path("byte_bpe_50k.tiktoken"), "rb").read())
ENC = bpe.Encoder(RANKS, P.PATTERN, memo=500)
REF = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def same(text):
    s = ENC.encode([text])[0]
    return list(map(int, s.split())) == REF.encode_ordinary(text) and ENC.decode(s) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_merges_equal_the_public_library(text):
    assert same(text)


@pytest.mark.parametrize("text", ["", " ", "a" * 5000, "ab" * 3000, " \n\t  x \x1c\x85 y", "don't we'll I'M",
                                  "<|endoftext|>", "日本語テキスト" * 50, "\U0001f600" * 200, "0123456789" * 300])
def test_merges_of_hard_texts(text):
    assert same(text)


def test_split_pattern_on_every_code_point():
    """The split agrees with the public library on each code point between letters."""
    rnd = random.Random(4)
    points = [c for c in range(0x3100) if not 0xD800 <= c < 0xE000] + rnd.sample(range(0xE000, 0x110000), 4000)
    text = [f"a{chr(c)}1{chr(c)}{chr(c)} " for c in points]
    assert [x for x, s in zip(text, ENC.encode(text)) if list(map(int, s.split())) != REF.encode_ordinary(x)] == []


def _segments(x):
    """Maximal scoring segments by their definition: best stretch, then both sides."""
    best = max(((sum(x[a:b]), -(b - a), -a) for a in range(len(x)) for b in range(a + 1, len(x) + 1)), default=(0,))
    if best[0] <= 0:
        return []
    a = -best[2]
    b = a - best[1]
    return _segments(x[:a]) + [(a, b)] + [(a2 + b, b2 + b) for a2, b2 in _segments(x[b:])]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([-3, -2, -1, 1, 2, 4]), max_size=14))
def test_all_maximal_segments(x):
    x = [v + 1e-3 * (i * i % 7) for i, v in enumerate(x)]  # no ties
    assert sorted((a, b) for a, b, _ in toxicity.segments(np.array(x, float))) == _segments(x)


def test_filter_returns_no_level_too_low():
    rng = np.random.default_rng(1)
    g = np.unique(rng.integers(0, 1 << 58, 3000, dtype=np.uint64))
    c = rng.integers(1, 500, len(g))
    bits, cutoff = lm.build_segment(g, c, 1 << 17)
    model = lm.BloomModel(np.concatenate([bits, np.zeros((63 << 17) >> 3, np.uint8)]), 1 << 17, 6, 1, 1, np.zeros(41))
    got, kept = model.levels(g), c >= cutoff
    assert (got[kept] >= lm.level(c[kept])).all() and (got[kept] == lm.level(c[kept])).mean() > 0.95
    other = np.unique(rng.integers(0, 1 << 58, 3000, dtype=np.uint64))
    assert (model.levels(np.setdiff1d(other, g)) > 0).mean() < 0.08
    small, cut = lm.build_segment(g, c, 1 << 14)
    assert cut > 1 and np.unpackbits(small).mean() < 0.55  # the rarest go, the filter never fills up


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 1000))
def test_overlaps_and_forest(seed):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.permutation(30)[:8] for _ in range(9)]).astype(np.int64)
    o = overlaps(x, x, step=5)
    assert (o == [[len(set(a) & set(b)) for b in x.tolist()] for a in x.tolist()]).all()
    w = np.where(o >= 4, o, 0)
    np.fill_diagonal(w, 0)
    r, c = forest(w, True)

    def parts(edges):
        p = list(range(9))
        for a, b in edges:
            a, b = p[a], p[b]
            p = [min(a, b) if v in (a, b) else v for v in p]
        return p
    assert parts(zip(r.tolist(), c.tolist())) == parts(zip(*map(list, np.nonzero(w))))
    assert len(r) == 9 - len(set(parts(zip(r.tolist(), c.tolist()))))


def test_decoded_filters_are_those_above_the_bar():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((20, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rotation, parts = caps.code(12, 3, 8)
    scores = np.zeros((20, 8 ** 3))
    for f in range(8 ** 3):
        words = (f // 64, f // 8 % 8, f % 8)
        scores[:, f] = sum((x @ rotation)[:, s] @ c[k] for (s, c), k in zip(parts, words))
    for i, ids in enumerate(caps.decode(x, 3, 8, 24)):
        assert len(ids) >= 12
        order = np.argsort(-scores[i])[:len(ids)]
        assert set(ids.tolist()) == set(order.tolist())


def test_equal_texts_have_equal_fingerprints_and_blocks_do_not_matter():
    texts = ["a b c d", None, "a b c d", "", "x " * 300 + "y"]
    f = simhash.fingerprints(pa.array(texts))
    assert f[0] == f[2] and f[1] == f[3] == 0
    assert (np.concatenate([simhash.fingerprints(pa.array([t], pa.string())) for t in texts]) == f).all()
