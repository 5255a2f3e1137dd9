"""Relational operators on small fixtures, checked against brute force."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from relevo.operators.attributes import aggregate_attributes
from relevo.operators.joins import union_all
from relevo.operators.knn import knn_join
from relevo.operators.order import assign_folds, row_index
from relevo.operators.tfidf import idf_table, tfidf_cosines


def test_attribute_aggregation_order_and_nan(spark):
    a = spark.createDataFrame([(1, 0, "a", "x"), (1, 1, "b", None), (2, 0, "c", "y")],
                              "product_uid long, pos long, name string, value string")
    got = {r["product_uid"]: r["product_attributes"] for r in aggregate_attributes(a).collect()}
    assert got == {1: "a x b nan", 2: "c y"}


def test_attribute_aggregation_chunks(spark):
    rows = [(1, i, f"n{i}", str(i)) for i in range(50)]
    a = spark.createDataFrame(rows, "product_uid long, pos long, name string, value string")
    got = aggregate_attributes(a, chunk=7).first()["product_attributes"]
    assert got == " ".join(f"n{i} {i}" for i in range(50))


def test_fold_sizes_23_rows(spark):
    df = spark.range(23).withColumnRenamed("id", "k").repartition(5)
    f = assign_folds(df, ["k"], 10)
    sizes = [r["count"] for r in f.groupBy("fold").count().orderBy("fold").collect()]
    assert sizes == [3, 3, 3, 2, 2, 2, 2, 2, 2, 2]
    order = [r["fold"] for r in f.orderBy("k").collect()]
    assert order == sorted(order)


def test_row_index_is_global_and_dense(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(7)
    idx = row_index(df, ["k"]).orderBy("k").collect()
    assert [r["row_idx"] for r in idx] == list(range(1000))


def test_union_missing_label_is_null(spark):
    tr = spark.createDataFrame([(1, 2.0)], "id long, relevance double")
    te = spark.createDataFrame([(2,)], "id long")
    got = {r["id"]: r["relevance"] for r in union_all(tr, te).collect()}
    assert got == {1: 2.0, 2: None}


def test_tfidf_token_in_every_document_and_no_common_token(spark):
    pairs = spark.createDataFrame(
        [(1, 1, "a", "a x"), (2, 2, "b", "a y"), (3, 3, "a", "a z")],
        "id long, product_uid long, search_term string, product_title string")
    products = spark.createDataFrame([(1, "d"), (2, "d e"), (3, "d")],
                                     "product_uid long, product_description string")
    idf = {r["token"]: r for r in idf_table(pairs, products).collect()}
    assert idf["a"]["df"] == 3 and idf["a"]["idf"] == 0.0     # in every document
    assert idf["x"]["idf"] == pytest.approx(math.log2(3))
    cos = {r["id"]: r for r in tfidf_cosines(pairs, products, ("title", "desc")).collect()}
    # 'a' has weight 0, so the search term's vector is empty -> 0
    assert cos[1]["tfidf_cos_sim_in_title"] == 0.0
    assert cos[2]["tfidf_cos_sim_in_title"] == 0.0            # 'b' unknown to the dictionary


def _shuffled_by(df) -> list[str]:
    """Columns of the plan's shuffles by hash."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    return [re.sub(r"#\d+L?", "", x) for x in re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)]


def _pairs_of_few_texts(spark):
    pairs = spark.createDataFrame(
        [(1, 1, "a a", "t x"), (2, 1, "b", "t x"), (3, 2, "c", None), (3, 2, "a", "u"), (None, 1, "t", "z")],
        "id long, product_uid long, search_term string, product_title string")
    products = spark.createDataFrame([(1, "d d a"), (1, "e"), (2, "a"), (9, "w"), (None, "v")],
                                     "product_uid long, product_description string")
    return pairs, products


def test_bag_of_words_shuffles_texts_not_tokens(spark):
    from relevo.operators.tfidf import bag_of_words
    pairs, products = _pairs_of_few_texts(spark)
    bow = bag_of_words(products, "product_uid", "product_description", "desc")
    assert sorted((r.key or 0, r.field, r.token, r.tf) for r in bow.collect()) == [
        (0, "desc", "v", 1), (1, "desc", "a", 1), (1, "desc", "d", 2), (1, "desc", "e", 1), (2, "desc", "a", 1), (9, "desc", "w", 1)]
    assert "key" in _shuffled_by(bow)
    assert sorted((r.key or 0, r.token, r.tf) for r in bag_of_words(pairs, "id", "search_term").collect()) == [
        (0, "t", 1), (1, "a", 2), (2, "b", 1), (3, "a", 1), (3, "c", 1)]


def test_dictionary_shuffles_no_tokens_of_products(spark):
    pairs, products = _pairs_of_few_texts(spark)
    idf = idf_table(pairs, products)
    assert {r.token: r.df for r in idf.collect()} == {"t": 2, "x": 2, "z": 1, "d": 3, "a": 4, "e": 3, "u": 1}
    assert not [x for x in _shuffled_by(idf) if "token" in x and "product_uid" in x]


def test_weights_are_shuffled_once_by_text(spark):
    from relevo.operators.tfidf import tfidf_weights
    bow = spark.createDataFrame([(1, "q", "a", 3), (1, "q", "b", 4), (1, "q", "zero", 1), (2, "q", "a", 1), (None, "q", "a", 1)],
                                "key long, field string, token string, tf long")
    idf = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("zero", 0.0)], "token string, idf double")
    got = tfidf_weights(bow, idf)
    assert sorted((r.key, r.token, r.w, r.nw) for r in got.collect()) == [(1, "a", 3.0, 0.6), (1, "b", 4.0, 0.8), (2, "a", 1.0, 1.0)]
    assert sum("key" in x for x in _shuffled_by(got)) == 1


def test_document_frequency_counts_pairs_not_products(spark):
    # product 1 appears in two pairs: its description tokens count twice
    pairs = spark.createDataFrame(
        [(1, 1, "q", "t"), (2, 1, "q", "u"), (3, 2, "q", "t")],
        "id long, product_uid long, search_term string, product_title string")
    products = spark.createDataFrame([(1, "d"), (2, "e d")],
                                     "product_uid long, product_description string")
    df = {r["token"]: r["df"] for r in idf_table(pairs, products).collect()}
    assert df == {"d": 3, "e": 1, "t": 2, "u": 1}


def test_document_frequency_description_without_tokens(spark):
    # product 2's description has no alphabetic token: its pair's text still
    # exists ("u . 123 . "), so the title token counts
    pairs = spark.createDataFrame(
        [(1, 1, "q", "t"), (2, 2, "q", "u"), (3, 3, "q", "v")],
        "id long, product_uid long, search_term string, product_title string")
    products = spark.createDataFrame([(1, "d"), (2, "123"), (3, None)],
                                     "product_uid long, product_description string")
    df = {r["token"]: r["df"] for r in idf_table(pairs, products).collect()}
    assert df == {"d": 1, "t": 1, "u": 1}          # product 3: null text, no tokens


def _brute_knn(q, p, k, exclude_self):
    out = {}
    for qi, qv in q:
        cand = [(math.dist(qv, pv), pi) for pi, pv in p if not (exclude_self and pi == qi)]
        out[qi] = [pi for _, pi in sorted(cand)[:k]]
    return out


@pytest.mark.parametrize("exclude_self", [False, True])
@pytest.mark.parametrize("block", [2048, 8])
def test_knn_matches_brute_force_with_duplicates(spark, exclude_self, block):
    rnd = random.Random(3)
    pts = []
    for i in range(400):
        if i % 3 == 0:      # a third of all points share one vector (hot key)
            v = [1.0, 2.0, 3.0]
        else:
            v = [float(rnd.randint(0, 6)), float(rnd.randint(0, 6)), rnd.random()]
        pts.append((i, v))
    qs = pts[::7] if exclude_self else [(10_000 + i, [rnd.random() * 6, rnd.random() * 6, 0.5])
                                        for i in range(40)]
    P = spark.createDataFrame(pts, "pid long, vec array<double>")
    Q = spark.createDataFrame(qs, "qid long, vec array<double>")
    k = 9
    got = knn_join(Q, P, k=k, exclude_self=exclude_self, block=block)
    rows = got.collect()
    res = {}
    for r in sorted(rows, key=lambda r: (r["qid"], r["rank"])):
        res.setdefault(r["qid"], []).append(r["pid"])
    assert res == _brute_knn(qs, pts, k, exclude_self)
    assert all(1 <= r["rank"] <= k for r in rows)


def test_vector_cosine_rules(spark):
    from relevo.operators.vectors import w2v_cosines
    vecs = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0]), ("c", [1.0, 1.0])],
                                 "word string, vec array<double>")
    texts = spark.createDataFrame(
        [(1, "a", "a c"), (2, "a", "zzz"), (3, "a", " "), (4, "b", "b")],
        "id long, search_term string, product_title string")
    got = {r["id"]: r["w2v_cos_sim_in_title"]
           for r in w2v_cosines(texts, vecs, {"title": "product_title"}, 2).collect()}
    mean = np.array([1.0, 0.5])
    assert got[1] == pytest.approx(mean[0] / np.linalg.norm(mean))
    assert got[2] == 0.0                   # unknown word
    assert math.isnan(got[3])              # text without tokens
    assert got[4] == pytest.approx(1.0)


def test_left_join_null_safe_keys(spark):
    from relevo.operators.joins import left_join
    left = spark.createDataFrame([(1, "a"), (None, "b")], "product_uid long, l string")
    right = spark.createDataFrame([(1, "x"), (None, "y")], "product_uid long, r string")
    plain = {r["l"]: r["r"] for r in left_join(left, right).collect()}
    safe = {r["l"]: r["r"] for r in left_join(left, right, null_safe=True).collect()}
    assert plain == {"a": "x", "b": None}
    assert safe == {"a": "x", "b": "y"}          # null keys meet, as in the reference


def test_product_dimension_loses_description_without_bullets(spark):
    from relevo.operators.joins import product_dimension
    desc = spark.createDataFrame([(1, "d1"), (2, "d2")], "product_uid long, product_description string")
    bullets = spark.createDataFrame([(1, "b1")], "product_uid long, bullets string")
    got = {r["product_uid"]: r["product_description"]
           for r in product_dimension(desc, bullets=bullets).collect()}
    kept = {r["product_uid"]: r["product_description"]
            for r in product_dimension(desc, bullets=bullets, keep_desc=True).collect()}
    assert got == {1: "d1 b1", 2: None}
    assert kept == {1: "d1 b1", 2: "d2"}


def test_vector_cosine_per_product_equals_per_pair(spark):
    from relevo.operators.joins import left_join
    from relevo.operators.vectors import w2v_cosines
    vecs = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0]), ("c", [1.0, 1.0])],
                                 "word string, vec array<double>")
    pairs = spark.createDataFrame(
        [(1, 10, "a", "b"), (2, 10, "b", "a"), (3, 11, "c", "c"), (4, 99, "a", "a")],
        "id long, product_uid long, search_term string, product_title string")
    products = spark.createDataFrame([(10, "a c b"), (11, "zzz")],
                                     "product_uid long, product_description string")
    fields = {"title": "product_title", "desc": "product_description"}
    per_product = {r["id"]: r for r in
                   w2v_cosines(pairs, vecs, fields, 2, products=products).collect()}
    joined = left_join(pairs, products).fillna(" ", ["product_description"])
    per_pair = {r["id"]: r for r in w2v_cosines(joined, vecs, fields, 2).collect()}
    for i in (1, 2, 3, 4):
        for c in ("w2v_cos_sim_in_title", "w2v_cos_sim_in_desc"):
            a, b = per_product[i][c], per_pair[i][c]
            assert (math.isnan(a) and math.isnan(b)) or a == pytest.approx(b)
    assert per_product[3]["w2v_cos_sim_in_desc"] == 0.0       # unknown word in the product text
    assert math.isnan(per_product[4]["w2v_cos_sim_in_desc"])  # missing product: empty text


def _axis(rnd, shape, n):
    if shape == "line":
        return [[rnd.random() * 100] for _ in range(n)]
    if shape == "collinear":
        return [[x, 2 * x + 1, -x] for x in (rnd.random() * 100 for _ in range(n))]
    return [[rnd.random() * 100, 7.0] for _ in range(n)]  # a constant column


@pytest.mark.parametrize("exclude_self", [False, True])
@pytest.mark.parametrize("shape", ["line", "collinear", "constant"])
def test_knn_is_exact_where_buckets_prune(spark, shape, exclude_self):
    """Blocks of 16 vectors: many cells and rings, so that most are left out."""
    rnd = random.Random(11)
    pts = list(enumerate(_axis(rnd, shape, 600)))
    qs = pts[::12] if exclude_self else [(10_000 + i, v) for i, v in enumerate(_axis(rnd, shape, 50))]
    k = 5
    got = knn_join(spark.createDataFrame(qs, "qid long, vec array<double>"),
                   spark.createDataFrame(pts, "pid long, vec array<double>"), k=k, exclude_self=exclude_self, block=16)
    found = {}
    for r in got.collect():
        found.setdefault(r.qid, {})[r["rank"]] = r.pid
    for q, v in qs:
        near = sorted((math.dist(v, p), i) for i, p in pts if not (exclude_self and i == q))[:k]
        assert [found[q][j + 1] for j in range(k)] == [i for _, i in near]


def _clusters(dim, n, seed=7):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim)) * 4
    return (centres[rng.integers(0, 12, n)] + rng.normal(size=(n, dim))).tolist()


def test_knn_carries_payload_and_ignores_vectors_that_are_none(spark):
    pts = [(1, [0.0, 0.0], "a"), (2, [1.0, 0.0], "b"), (3, None, "c"), (4, [None, 1.0], "d"),
           (5, [float("nan"), 0.0], "e"), (6, [float("inf"), 0.0], "f"), (7, [0.0, 3.0], None)]
    P = spark.createDataFrame(pts, "pid long, vec array<double>, name string")
    got = knn_join(P.select(P.pid.alias("qid"), "vec"), P, k=2, payload=["name"], exclude_self=True)
    rows = {(r.qid, r["rank"]): (r.pid, r.dist, r.name) for r in got.collect()}
    assert rows == {(1, 1): (2, 1.0, "b"), (1, 2): (7, 3.0, None), (2, 1): (1, 1.0, "a"),
                    (2, 2): (7, math.sqrt(10), None), (7, 1): (1, 3.0, "a"), (7, 2): (2, math.sqrt(10), "b")}
    assert knn_join(P.select(P.pid.alias("qid"), "vec"), P.where("pid > 99"), k=2).collect() == []


def test_knn_many_dimensions_close_points_and_busy_blocks(spark, monkeypatch):
    """Distances far below the rounding of a matrix product; more visitors than a chunk takes."""
    from relevo.operators import knn
    monkeypatch.setattr(knn, "QUERIES", 20)
    rng = np.random.default_rng(5)
    x = np.array(_clusters(20, 150)) + 1000
    x[40:80] = x[40] + rng.normal(size=(40, 20)) * 1e-9
    pts = list(enumerate(x.tolist()))
    P = spark.createDataFrame(pts, "pid long, vec array<double>")
    got = knn_join(P.withColumnRenamed("pid", "qid"), P, k=7, exclude_self=True, block=12)
    found = {}
    for r in got.collect():
        found.setdefault(r.qid, {})[r["rank"]] = (r.pid, r.dist)
    for i, v in pts:
        near = sorted((math.dist(v, p), j) for j, p in pts if j != i)[:7]
        assert [found[i][j][1] for j in range(1, 8)] == pytest.approx([d for d, _ in near], rel=1e-12)
    assert len(found) == 150


def _clustered_points(spark, n):
    P = spark.createDataFrame(list(enumerate(_clusters(6, n))), "pid long, vec array<double>")
    return P.withColumnRenamed("pid", "qid"), P


def test_knn_found_points_are_one_row_a_query_and_unit(spark, monkeypatch):
    """What is shuffled: before, a row a point and block, and blocks of one size however many vectors there are."""
    from relevo.operators import knn
    units, blocks_met = [], []
    plain = knn._nearest_in_units

    def counted(visits, blocks, *rest):
        units.append((visits, plain(visits, blocks, *rest)))
        blocks_met.append(blocks.count())
        return units[-1][1]

    monkeypatch.setattr(knn, "_nearest_in_units", counted)
    monkeypatch.setattr(knn, "BLOCK", 16)
    monkeypatch.setattr(knn, "QUERIES", 16)
    Q, P = _clustered_points(spark, 1600)
    for join in (knn.knn_join, knn.knn_lsh):
        assert join(Q, P, k=5, exclude_self=True).count() == 1600 * 5
        for visits, found in units:
            assert found.count() <= visits.count()
    # every block meets 16 chunks of 100 queries; in LSH each of 8 tables has all vectors
    assert blocks_met == [1600 * 16, 1600 * 16, 8 * 1600 * 16]


def test_knn_cuts_of_large_blocks_lose_nothing(spark, monkeypatch):
    from relevo.operators import knn
    monkeypatch.setattr(knn, "LARGE", 30)
    monkeypatch.setattr(knn, "TILE", 100)
    monkeypatch.setattr(knn, "MERGE", 7)
    Q, P = _clustered_points(spark, 200)
    pts = [(r.pid, r.vec) for r in P.collect()]
    found = {}
    for r in knn_join(Q, P, k=4, exclude_self=True).collect():
        found.setdefault(r.qid, {})[r["rank"]] = r.pid
    assert {q: [f[j] for j in range(1, 5)] for q, f in found.items()} == _brute_knn(pts, pts, 4, True)


def test_lsh_candidates_find_most_neighbours(spark):
    from relevo.operators.knn import knn_lsh
    pts = list(enumerate(_clusters(8, 700)))
    P = spark.createDataFrame(pts, "pid long, vec array<double>")
    Q = P.withColumnRenamed("pid", "qid")
    exact = {(r.qid, r.pid): r.dist for r in knn_join(Q, P, k=10, exclude_self=True).collect()}
    got = {(r.qid, r.pid): r.dist for r in knn_lsh(Q, P, k=10, exclude_self=True).collect()}
    assert len(got.keys() & exact.keys()) >= 0.9 * len(exact)
    both = got.keys() & exact.keys()
    assert all(got[p] == pytest.approx(exact[p], rel=1e-9, abs=1e-12) for p in both)
    assert all(got[p] >= min(d for (q, _), d in exact.items() if q == p[0]) - 1e-9 for p in list(got)[:50])


def test_text_vectors_are_weighted_means_of_known_words(spark):
    from relevo.operators.vectors import text_vectors
    vecs = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "word string, vec array<double>")
    texts = spark.createDataFrame([(1, "a a b", "b"), (2, "a zz zz", ""), (3, None, "a b")], "id long, x string, y string")
    got = {(r.id, r.field): (r.n, r.n_unknown, r["mean"]) for r in text_vectors(texts, "id", {"x": "x", "y": "y"}, vecs, 2).collect()}
    assert got[1, "x"][:2] == (3, 0) and got[1, "x"][2] == pytest.approx([2 / 3, 1 / 3])
    assert got[1, "y"] == (1, 0, [0.0, 1.0]) and got[3, "y"] == (2, 0, [0.5, 0.5])
    assert got[2, "x"] == (3, 2, None) and got[2, "y"] == (0, 0, None) and got[3, "x"] == (0, 0, None)


def test_word_vectors_do_not_depend_on_the_layout(spark):
    from relevo.operators.vectors import train_word2vec, vector_table
    rnd = random.Random(4)
    rows = [(i, [f"w{rnd.randrange(30)}" for _ in range(8)]) for i in range(200)]
    found = []
    for parts in (2, 5):
        d = spark.createDataFrame(rows, "id long, tokens array<string>").repartition(parts)
        model = train_word2vec(d, vector_size=8, min_count=1, partitions=1, max_iter=2, order=("id",))
        found.append({r.word: r.vec for r in vector_table(model).collect()})
    assert found[0].keys() == found[1].keys()
    assert found[0] == found[1]


def test_knn_regression_asks_once_a_distinct_vector(spark, monkeypatch):
    from relevo.operators import knn
    train = spark.createDataFrame([(i, [float(i % 40), float(i // 40)], float(i % 7)) for i in range(200)],
                                  "id long, vec array<double>, relevance double")
    rows = [(1000 + i, [float(i % 5), -0.0 if i % 2 else 0.0]) for i in range(60)]
    odd = [(1, [1.0, 1.0]), (1, [30.0, 2.0]), (None, [2.0, 2.0]), (2, None), (3, [float("nan"), 0.0])]
    test = spark.createDataFrame(rows + odd, "id long, vec array<double>")
    asked = []

    def join(queries, points, **kw):
        asked.append(queries.count())
        return plain(queries, points, **kw)

    plain = knn.knn_join
    want = {r["qid"]: r["p"] for r in plain(test.withColumnRenamed("id", "qid"), train.withColumnRenamed("id", "pid"),
                                            k=9, payload=["relevance"]).groupBy("qid").agg(F.avg("relevance").alias("p")).collect()}
    monkeypatch.setattr(knn, "knn_join", join)
    found = knn.knn_regress(train, test, k=9).collect()
    got = {r["id"]: r["prediction"] for r in found}
    assert len(found) == len(got) == 62 and got == pytest.approx(want)
    assert asked == [5, 3]  # the distinct vectors; the rows with a shared id and without one


def test_pairs_share_the_weights_of_their_product(spark):
    """descriptions are weighted once a product; ids of several rows, products twice and nulls as pair by pair."""
    from relevo.operators.joins import left_join
    from relevo.operators.tfidf import bag_of_words, idf_table, product_weights_of_pairs, tfidf_weights
    pairs = spark.createDataFrame(
        [(1, 10, "red"), (2, 10, "blue"), (3, 11, "red"), (4, 12, ""), (5, None, "x"), (6, 10, "red"), (6, 11, "red"),
         (7, 13, "a"), (7, 13, "a"), (None, 10, "b"), (8, 99, "gone"), (9, 11, None)],
        "id long, product_uid long, product_title string")
    products = spark.createDataFrame(
        [(10, "red pump red"), (11, "blue pump"), (11, "pump pump steel"), (12, None), (13, "steel"), (None, "lost"), (14, "unasked word")],
        "product_uid long, product_description string")
    idf = idf_table(pairs, products)
    want = tfidf_weights(bag_of_words(left_join(pairs, products), "id", "product_description", "desc"), idf)
    shared, others = product_weights_of_pairs(pairs, products, "product_description", "desc", idf)
    assert {r.id for r in others.collect()} == {6, 7}
    rest = tfidf_weights(bag_of_words(left_join(others, products), "id", "product_description", "desc"), idf)
    as_dict = lambda df: {(r.key, r.field, r.token): (r.w, r.nw) for r in df.collect()}
    want, got = as_dict(want), as_dict(shared.unionByName(rest))
    assert len(want) == 15 and got.keys() == want.keys() and shared.unionByName(rest).count() == len(want)
    assert all(got[k] == pytest.approx(want[k]) for k in want)
    assert {r.key for r in shared.collect()} == {1, 2, 3, 9}
    # no shuffle between a product's weights and its pairs
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = shared._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    window = plan[:plan.index("Window")]
    assert "Exchange" not in window
