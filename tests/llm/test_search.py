"""Operator 12: scores and ranks against plain Python and SQL."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from test_queries import docs_of, trap_rows, write

from conftest import SF_SMALL
from relevo.llm import search as S
from relevo.llm.queries import ORACLE_SQL, QUERIES

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(t):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def expected(docs, items, k=10):
    held = [(i, Counter(ts), len(ts)) for i, t in docs if (ts := terms(t))]
    n_docs, all_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in held:
            m = 10 + 90 * n * n_docs // all_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in set(terms(text)) if c[t])
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, r, None if no_id else i, -s) for r, (s, no_id, i) in enumerate(sorted(scores)[:k], 1)]
    return Counter(out)


def items_of(spark, sf):
    return [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]


@pytest.mark.parametrize("where", ["traps", "given"])
def test_query_by_brute_force(spark, tmp_path, where):
    rows = trap_rows() + [(k, BASE_TIES[k % 3], "en", "a", 9) for k in range(40, 90)]
    sf = SF_SMALL if where == "given" else write(spark, tmp_path, rows)
    got = Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in QUERIES["op12_ranked_search"](spark, sf).collect())
    assert got == expected(docs_of(spark, sf), items_of(spark, sf))


BASE_TIES = ["one t1 t2", "One, two!", "two t1 ONE one"]


def test_sql_says_the_same(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = Counter(con.execute(ORACLE_SQL["op12_ranked_search"]).fetchall())
    assert Counter(tuple(r) for r in QUERIES["op12_ranked_search"](spark, SF_SMALL).collect()) == want


def test_groups_of_items_and_layouts_give_one_result(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    once = Counter(tuple(r) for r in S.ranked_documents(docs, items, k=3).collect())
    cut = S.ranked_documents(docs.repartition(7, "source"), items, k=3, group_terms=300)
    assert Counter(tuple(r) for r in cut.collect()) == once
    assert len(list(S.item_groups(items, "item_id", "text", 300))) > 3


def test_products_are_cut_below_the_exact_bound():
    group = S.Group([1, 2], np.arange(50, dtype=np.uint64), [np.arange(40), np.arange(10, 50)])
    w = np.arange(1, 51) * 1000
    [(numbers, parts)] = S.item_tiles(group, w, exact=100_000 * S.IMPACT)
    assert numbers.tolist() == [0, 1] and len(parts) > 10
    for columns, dense in parts:
        assert len(columns) == 1 or dense.sum(axis=1).max() < 100_000
    assert np.concatenate([c for c, _ in parts]).tolist() == list(range(50))
    assert sum(d.sum() for _, d in parts) == w[:40].sum() + w[10:].sum()
    assert len(S.item_tiles(group, w)[0][1]) == 1


def test_ties_are_cut_by_id_only():
    rng = np.random.default_rng(3)
    scores, ids = rng.integers(0, 4, (5, 400)), rng.permutation(400)
    no_id = rng.random(400) < 0.02
    best = S.Best(5, 10)
    for lo in range(0, 400, 37):
        best.add(scores[:, lo:lo + 37], ids[lo:lo + 37], no_id[lo:lo + 37])
    for i in range(5):
        want = sorted((-s, bool(z), d) for s, z, d in zip(scores[i].tolist(), no_id, ids.tolist()) if s > 0)[:10]
        use = best.item == i
        assert [(-s, bool(z), d) for s, z, d in zip(best.score[use].tolist(), best.no_id[use], best.doc[use].tolist())] == want


def test_impacts_do_not_overflow():
    big = S.impacts(np.array([5]), np.array([10**7]), 10**12, 10**14)
    assert big.tolist() == [10**9 * 5 // (5000 + 8 * (10 + 90 * 10**7 * 10**12 // 10**14))]
