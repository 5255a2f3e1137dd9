"""Property tests: ratio symmetric and bounded, LCS against a DP,
stems idempotent on their own output length, clip idempotent, folds
balanced, TF-IDF cosine bounded."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from relevo.functions.clip import clip_both, clip_upper
from relevo.functions.edit import lcs_length, ratio
from relevo.functions.porter2 import stem
from relevo.operators.order import kfold_of

TEXT = st.text(alphabet="abcé .x", max_size=40)


def _lcs_dp(a, b):
    prev = [0] * (len(b) + 1)
    for x in a:
        cur = [0]
        for j, y in enumerate(b):
            cur.append(prev[j] + 1 if x == y else max(prev[j + 1], cur[j]))
        prev = cur
    return prev[-1]


@settings(max_examples=300, deadline=None)
@given(TEXT, TEXT)
def test_ratio_symmetric_bounded_and_exact(a, b):
    r = ratio(a, b)
    assert r == ratio(b, a)
    assert 0.0 <= r <= 1.0
    assert lcs_length(a, b) == _lcs_dp(a, b)
    if a == b:
        assert r == 1.0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcdefghilmnorstuy'", min_size=1, max_size=14))
def test_stem_never_grows_much_and_is_lowercase(w):
    s = stem(w)
    assert s == s.lower()
    assert len(s) <= len(w) + 1          # only step 1b may add one 'e'


def test_clip_idempotent_and_bounded(spark):
    vals = [-5.0, 0.2, 1.0, 2.5, 3.0, 3.4, 1e9, float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "p double")
    once = df.select(clip_both("p").alias("p"))
    twice = once.select(clip_both("p").alias("p"))
    a = [r["p"] for r in once.collect()]
    b = [r["p"] for r in twice.collect()]
    assert all((math.isnan(x) and math.isnan(y)) or x == y for x, y in zip(a, b))
    assert all(math.isnan(x) or 1.0 <= x <= 3.0 for x in a)
    up = [r["p"] for r in df.select(clip_upper("p").alias("p")).collect()]
    assert all(math.isnan(x) or x <= 3.0 for x in up)


def test_fold_sizes_differ_by_at_most_one(spark):
    for n, k in [(1, 1), (9, 10), (10, 10), (23, 10), (101, 7), (1000, 10)]:
        df = spark.range(n).select(F.col("id").alias("idx"))
        sizes = {r["f"]: r["count"] for r in df.select(
            kfold_of(F.col("idx"), F.lit(n), k).alias("f")).groupBy("f").count().collect()}
        assert sum(sizes.values()) == n
        assert max(sizes.values()) - min(sizes.values()) <= 1
        # contiguous and in order: larger folds first
        order = sorted(sizes)
        assert order == list(range(len(order)))
        assert [sizes[f] for f in order] == sorted(sizes.values(), reverse=True)


def test_tfidf_cosine_bounded(spark):
    import __spark_entry__ as E
    from conftest import SF_SMALL
    out = E.queries()["A5_tfidf_cosine"](spark, SF_SMALL)
    row = out.agg(F.min("tfidf_cos_sim_in_title"), F.max("tfidf_cos_sim_in_title"),
                  F.min("tfidf_cos_sim_in_desc"), F.max("tfidf_cos_sim_in_desc")).first()
    assert row[0] >= 0 and row[1] <= 1.0 + 1e-9 and row[2] >= 0 and row[3] <= 1.0 + 1e-9
