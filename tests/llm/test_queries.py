"""The registered queries against brute force, on the smallest given tables
and on tables full of traps."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from relevo.llm import caps, common, lines, lm, minhash, mixture, repeats, simhash
from relevo.llm.graph import components
from relevo.llm.queries import QUERIES

DOC = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i * i % 977}" for i in range(30_000))
BASE = " ".join(f"t{i}" for i in range(60))


def trap_rows():
    near = BASE.split()
    near[30] = "zz"
    rows = [(1, BASE, "en", "b"), (2, BASE, "en", None), (3, " ".join(near), None, "a"), (4, None, "en", "a"),
            (5, "", "de", ""), (6, " \n\t", None, "a"), (7, LONG, "en", "c"), (8, "one two", "de", "a"),
            (9, "ONE Two", "de", "a"), (10, "123 456 --", "en", "a"), (11, "ß é", "de", "b"),
            (12, "x\n" + BASE + "\ny z", "en", "b"), (12, "x\n" + BASE + "\ny z", "en", "b"), (None, BASE, "en", "a"),
            (13, "w " * 2000, "en", "a"), (14, None, None, None)]
    return [(i, t, la, s, len(t or "")) for i, t, la, s in rows]


def write(spark, path, docs, vectors=()):
    df = spark.createDataFrame(docs, DOC)
    # names that operators use inside
    df = df.selectExpr("*", "1 as digest", "'x' as h", "2 as n", "3 as rep", "'y' as `row`", "4 as part", "5 as words",
                       "6 as bucket", "7 as _s", "'q' as score", "8 as label", "9 as `end`")
    df.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (3, 1, 1), (7, 0, 0), (8, 0, 1), (8, 1, None), (None, 0, 1)],
                          "doc_id long, quality int, toxic int").where("doc_id is null or true" if docs else "false"
                                                                       ).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, "one two BASE t1", 1), (2, None, 1), (3, "", 1), (4, BASE, 2), (4, "ß w1", 3), (None, "one", 4),
                           (5, "nothing-known", 5), (6, BASE + " t1 t1", 6)] if docs else [],
                          "item_id long, text string, score int").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame(list(vectors), "vec_id long, embedding array<float>, label int").write.parquet(
        f"{path}/embeddings.parquet")
    return str(path)


VECTORS = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], None), (3, [2.0, 0.01], 1), (4, [0.0, 0.0], 1), (5, None, 1),
           (6, [float("nan"), 1.0], 1), (7, [None, 1.0], 1), (8, [0.0, 1.0], 1), (9, [1.0], 1), (10, [], 1),
           (None, [1.0, 0.0], 1), (11, [float("inf"), 0.0], 1), (12, [0.0, -1.0], 1), (13, [-0.0, 1.0], 2)]


@pytest.fixture(scope="module")
def trap_dir(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("traps"), trap_rows(), VECTORS)


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("empty"), [], [])


PER_DOC = sorted(q for q in QUERIES if q.split("_")[0] not in ("op2", "op3", "op8", "op12"))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).collect() == []


@pytest.mark.parametrize("name", PER_DOC)
def test_one_row_a_document(spark, trap_dir, name):
    got = QUERIES[name](spark, trap_dir).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in trap_rows())


def crc(i, n):
    return zlib.crc32(str(i).encode()) % n


def words(t):
    return (t or "").encode().lower().split()


def docs_of(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]


def union(links, ids):
    p = {i: i for i in ids}

    def root(x):
        while p[x] != x:
            x = p[x]
        return x
    for a, b in links:
        a, b = root(a), root(b)
        p[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("where", ["traps", "given"])
def test_op1_base_scores(spark, trap_dir, where):
    sf = trap_dir if where == "traps" else SF_SMALL
    docs = [(i, [*words(t), b"\n"]) for i, t in docs_of(spark, sf)]
    c = Counter(w for i, ws in docs if i is not None and crc(i, 5) != 1 for w in ws)
    n, v = sum(c.values()), len(c)
    want = Counter((i, len(ws), sum(c[w] > 0 for w in ws),
                    round(sum(math.log10((c[w] + .5) / (n + .5 * (v + 1))) for w in ws), 4)) for i, ws in docs)
    got = QUERIES["op1_bloom_lm"](spark, sf).collect()
    assert Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 4)) for r in got) == want
    assert all(r.train_tokens == n and r.held_out == (None if r.doc_id is None else crc(r.doc_id, 5) == 1) for r in got)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    held = [r for r in got if r.held_out]
    if where == "given":
        assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_op1_keeps_every_ngram(spark):
    """However small the filter begins, it grows: nothing seen in training scores as never seen."""
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    learn, held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1, F.lit(False)
    _, texts = lm.fit(d, learn, held, bits=1 << 10)
    own = [x for r in texts.where("learn").collect() for x in r.triples]
    assert own and all(x % lm.LEVELS and x // lm.LEVELS % lm.LEVELS and x // lm.LEVELS ** 2 for x in own)


def test_op2_finds_passages_inside_lines(spark):
    rng = np.random.default_rng(2)
    text = lambda n: " ".join(f"v{x}" for x in rng.integers(0, 4000, n))
    docs = [(i, text(200) + "\n" + text(80)) for i in range(60)]
    planted = {}
    for k in range(12):
        passage = text(51)
        for i in (k, k + 20, k + 40):
            a, b = docs[i][1][:400], docs[i][1][400:]
            docs[i] = (i, f"{a} {passage} {b}")
            planted[i] = passage
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    runs = repeats.repeated_runs(d)
    got = runs.collect()
    assert {r.doc_id for r in got} == {i for i in planted if i >= 20}
    for r in got:
        assert r.first_doc_id == r.doc_id % 20
        assert docs[r.doc_id][1][r.start:r.end] in " " + planted[r.doc_id] + " "
    left = {r.doc_id: r.text for r in repeats.remove_runs(d, runs).collect()}
    for i, t in docs:
        cut = t
        for r in sorted((r for r in got if r.doc_id == i), key=lambda r: -r.start):
            cut = cut[:r.start] + cut[r.end:]
        assert left[i] == cut


def test_op2_units_by_brute_force(spark, trap_dir):
    """Runs are those of units whose digest was seen before, in rank order."""
    d = spark.read.parquet(f"{trap_dir}/documents.parquet")
    seen, want = {}, defaultdict(int)
    rows = {(r.doc_id, r.unit): (r.digest, r.words) for r in repeats.units(d).collect()}
    runs, last = defaultdict(int), None
    for (i, u), (g, n) in sorted(rows.items()):
        if g in seen:
            last = last if last and last[0] == i and last[2] == u - 1 else (i, u, u)
            last = (i, last[1], u)
            runs[last[:2]] += n
        seen.setdefault(g, (i, u))
    want = Counter((i, n) for (i, _), n in runs.items() if n >= repeats.MIN_WORDS)
    assert Counter((r.doc_id, r.n_words) for r in repeats.repeated_runs(d).collect()) == want
    assert sum(want.values()) >= 3


def test_op2_whole_lines_of_any_length(spark, trap_dir):
    docs = [(1, "menu\nlog in\n" + BASE), (2, "x y\nLog  in\nq\nmenu\nlog out"), (3, BASE + "\nlog in\nr")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    runs = repeats.repeated_runs(d, whole_lines=True)
    got = {(r.doc_id, docs[r.doc_id - 1][1][r.start:r.end], r.n_words, r.first_doc_id) for r in runs.collect()}
    assert got == {(2, "Log  in", 2, 1), (2, "menu", 1, 1), (3, BASE + "\nlog in", 62, 1)}
    assert 9 in {r.doc_id for r in QUERIES["op2_substring_dedup"](spark, trap_dir).collect()}


def _vectors_brute(rows, threshold=0.95):
    ok = {i: np.array(v, float) for i, v, _ in rows if i is not None and v and None not in v
          and np.isfinite(v).all() and np.any(v)}
    links = [(a, b) for a in ok for b in ok if a < b and len(ok[a]) == len(ok[b])
             and ok[a] @ ok[b] / np.linalg.norm(ok[a]) / np.linalg.norm(ok[b]) >= threshold]
    n = Counter(x for p in links for x in p)
    return n, union(links, [i for i, *_ in rows if i is not None])


@pytest.mark.parametrize("block", [8, 1024])
def test_op3_against_brute_force(spark, block):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((25, 24))
    rows = list(VECTORS) + [(100 + k, (centres[k % 25] + (0.02 + 0.01 * (k % 7)) * rng.standard_normal(24) * 2).tolist(), 0)
                            for k in range(250)]
    rows += [(500 + k, centres[0].tolist(), k) for k in range(40)]  # a hot vector
    rows = [(i, v if v is None or None in v else np.array(v, np.float32).tolist(), la) for i, v, la in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    n, comp = _vectors_brute(rows)
    got = caps.similar_vectors(df, block=block).collect()
    assert len(got) == len(rows)
    found = sum(r.n_links for r in got)
    assert 0.99 * sum(n.values()) <= found <= sum(n.values())
    assert all(r.component_id == (None if r.vec_id is None else comp[r.vec_id]) for r in got)
    assert all(r.n_links == n[r.vec_id] for r in got if r.vec_id is None or r.vec_id < 100)


def _targets(sizes, weights=(5, 2, 1), most=3):
    """Repeated resharing, as the text of the contract says."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % 3] for k, s in enumerate(order)}
    total, out, open_ = sum(sizes.values()), {}, set(order)
    while open_:
        left = total - sum(out.values())
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > most * sizes[s] + 1e-9}
        if not full:
            return {**out, **share}
        out.update({s: most * sizes[s] for s in full})
        open_ -= full
    return out


def test_op4_targets_and_pieces(spark, trap_dir):
    sizes = {"a": 10.0, "b": 500.0, "c": 300.0, "d": 1000.0, None: 40.0, "e": 0.0, "f": 7.0}
    df = spark.createDataFrame([(s, int(x)) for s, x in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in mixture.targets(df).collect()}
    assert got == pytest.approx(_targets(sizes))
    for sf in (SF_SMALL, trap_dir):
        rows = mixture.mix_sources(spark.read.parquet(f"{sf}/documents.parquet"), shards=4).collect()
        assert rows == [r for r in rows if sum(p.words for p in r.pieces) <= 3 * r["size"]]
        for s in {r.source for r in rows}:
            own = [r for r in rows if r.source == s]
            size = sum(r["size"] for r in own)
            assert all(r.source_size == size for r in own)
            assert sum(p.words for r in own for p in r.pieces) == pytest.approx(own[0].target, abs=1)
        assert sum({r.source: r.target for r in rows}.values()) == pytest.approx(sum(r["size"] for r in rows))
        for r in rows:  # the pieces of one repeat are disjoint
            by = defaultdict(list)
            for p in r.pieces:
                by[p.repeat].append((p.from_word, p.from_word + p.words))
            for spans in by.values():
                spans.sort()
                assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:])) and spans[-1][1] <= r["size"]


def test_op4_shards_take_equal_shares_and_reruns_agree(spark):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    one = mixture.mix_sources(d, shards=4).orderBy("doc_id").collect()
    assert one == mixture.mix_sources(d.repartition(7), shards=4).orderBy("doc_id").collect()
    per = Counter()
    for r in one:
        for p in r.pieces:
            per[p.shard] += p.words
    assert max(per.values()) < 1.3 * min(per.values())  # a source's last block may be short


def test_op4_draws_follow_the_hypergeometric_law(spark):
    df = spark.createDataFrame([(0, 30.0), (1, 50.0), (2, 20.0)], "rank int, target double")
    draws = []
    for seed in range(40):
        rows = mixture.shard_quotas(df, 2, F.lit(1), seed).orderBy("rank").collect()
        assert [r.cuts[-1] for r in rows] == [30, 50, 20] and sum(r.cuts[1] for r in rows) == 50
        draws.append([r.cuts[1] for r in rows])
    assert np.allclose(np.mean(draws, axis=0), [15, 25, 10], atol=1.3)
    assert 1.0 < np.std([x[0] for x in draws]) < 3.6  # 2.3 by the law


def test_mixed_documents_cut_whole_words(spark, trap_dir):
    d = spark.read.parquet(f"{trap_dir}/documents.parquet")
    rows = mixture.mixed_documents(d, shards=4).collect()
    texts = {r.doc_id: r.text for r in d.collect()}
    assert set(rows[0].asDict()) == set(d.columns)
    assert all(r.text and r.text in texts[r.doc_id] for r in rows)
    took = Counter()
    for r in rows:
        took[r.doc_id] += len(words(r.text))
    want = {r.doc_id: sum(p.words for p in r.pieces) for r in mixture.mix_sources(d, shards=4).where("doc_id <> 12").collect()}
    assert {i: n for i, n in want.items() if n} == {i: n for i, n in took.items() if i != 12 and i is not None}


def test_op5_round_trip(spark, trap_dir):
    import public_tokenizers as P
    import tiktoken
    from relevo.llm.bpe import read_ranks
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                            mergeable_ranks=read_ranks(open(P.path("byte_bpe_50k.tiktoken"), "rb").read()))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for sf in (SF_SMALL, trap_dir):
        want = Counter()
        for i, t in docs_of(spark, sf):
            ids = enc.encode_ordinary(t or "")
            want[i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())] += 1
        got = QUERIES["op5_byte_bpe"](spark, sf).collect()
        assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want


def test_op5_packed_ids(spark):
    import public_tokenizers as P
    from relevo.llm import bpe
    d = spark.createDataFrame([(1, "the end of the Zebra"), (2, None)], "doc_id long, text string")
    enc = bpe.Encoder(bpe.read_ranks(open(P.path("byte_bpe_50k.tiktoken"), "rb").read()), P.PATTERN)
    got = {r.doc_id: r for r in bpe.encode_documents(
        d, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, ids=True).collect()}
    ids = np.frombuffer(got[1]["ids"], "<u2")
    assert enc.decode(" ".join(map(str, ids))) == b"the end of the Zebra" and len(ids) == got[1].n_tokens
    assert got[2]["ids"] == b""


def test_op6_held_out_accuracy(spark, trap_dir):
    sf = SF_SMALL.replace("sf0.001", "sf0.01")
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op6_language_id"](spark, sf).collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (crc(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in got)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.98
    assert sum(r.rejected for r in got) <= 3
    for r in QUERIES["op6_language_id"](spark, trap_dir).collect():
        assert (r.lang_pred == "und") == (r.doc_id in (4, 5, 6, 10, 14))
        assert r.lang_pred in ("en", "de", "und")


def _shingles(t):
    w = words(t)
    return {tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()


def _near(docs):
    sets = [(i, _shingles(t)) for i, t in docs]
    links = [(a, b) for k, (a, s) in enumerate(sets) for b, r in sets[k + 1:]
             if a is not None and b is not None and s and 100 * len(s & r) >= 75 * len(s | r)]
    return sets, union(links, [i for i, _ in docs if i is not None])


def test_op7_against_brute_force(spark, trap_dir):
    rng = np.random.default_rng(7)
    docs, base = [], [f"v{x}" for x in rng.integers(0, 900, 130)]
    for k in range(160):  # near copies from close to far, around the threshold
        w = list(base) if k % 2 else [f"v{x}" for x in rng.integers(0, 900, 20 + k)]
        for p in rng.integers(0, len(w), k // 16):
            w[p] = f"n{rng.integers(0, 9999)}"
        docs.append((k, " ".join(w)))
    docs += [(200 + k, docs[k][1]) for k in range(0, 60, 3)]
    cases = [docs, docs_of(spark, trap_dir), docs_of(spark, SF_SMALL)]
    for case in cases:
        sets, comp = _near(case)
        got = minhash.near_duplicates(spark.createDataFrame(case, "doc_id long, text string").repartition(4)).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(
            (i, len(s), comp.get(i)) for i, s in sets)
        assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_op7_small_sets_at_the_threshold(spark):
    """Sets smaller than the sketch whose union is larger than it: 54 / 72 = 0.75 and so on."""
    docs, pairs = [], []
    for k in range(120):
        n, m, both = [(63, 63, 54), (63, 58, 52), (62, 61, 53), (60, 55, 50)][k % 4]
        w = [f"p{k}x{x}" for x in range(n + 4)]
        other = w[:both + 4] + [f"q{k}x{x}" for x in range(m - both)]
        docs += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(other))]
        pairs.append((len(_shingles(docs[-2][1]) & _shingles(docs[-1][1])), len(_shingles(docs[-1][1]))))
    assert (54, 63) in pairs and (53, 61) in pairs
    _, comp = _near(docs)
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: r.component_id for r in got} == comp and sum(not r.kept for r in got) == 120


def test_op8_lines_of_few_words(spark):
    """The query leaves no repeated line out, however few words it has."""
    docs = [(1, "menu\nlog in\na b c d\nq"), (2, "Menu\nlog out\nin log\nd c b a\na b c d e\n\nz"), (3, "menu")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.line) for r in lines.repeated_lines(d).collect()}
    assert got == _lines(docs, least=1) == {(2, 0), (2, 2), (2, 3), (2, 4), (3, 0)}


def test_op8_query_has_no_floor(spark, trap_dir):
    got = {(r.doc_id, r.line) for r in QUERIES["op8_line_dedup"](spark, trap_dir).collect()}
    docs = docs_of(spark, trap_dir)
    assert got == _lines(docs, least=1) and (9, 0) in got


def _lines(docs, percent=lines.PERCENT, least=lines.MIN_WORDS):
    rows = sorted({(i, k, frozenset(words(x))) for i, t in docs if i is not None and t is not None
                   for k, x in enumerate(t.split("\n"))}, key=lambda r: r[:2])
    rows = [r for r in rows if len(r[2]) >= least]
    return {b[:2] for k, b in enumerate(rows) if any(
        a[:2] != b[:2] and 100 * len(a[2] & b[2]) >= percent * len(a[2] | b[2]) for a in rows[:k])}


def test_op8_marks_tell_lines_apart(spark):
    rows = [(k * 7, k % 50) for k in range(3000)]
    bits, table = lines._marks(spark.createDataFrame(rows, "doc long, line long"))

    def marked(rows):
        return common.marked(lines._line_hash(*np.array(rows).T), bits, table.value)
    assert marked(rows).all()
    assert marked([(k * 7 + 1, k % 50) for k in range(3000)]).mean() < 0.1


def test_op8_only_close_pairs_meet_their_sets(spark, monkeypatch):
    """Unlike pairs end at the wide parity maps, and no pass over the texts shuffles them."""
    plans, staged = [], lines.stage

    def stage(df, name):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return staged(df, name)

    monkeypatch.setattr(lines, "stage", stage)
    monkeypatch.setattr(lines, "CANDIDATES", 1)
    # two thirds in common: too little, however many pairs share words
    docs = [(i, " ".join([f"k{x}" for x in range(80)] + [f"y{i}x{k}" for k in range(40)])) for i in range(12)]
    docs += [(50 + i, " ".join(f"h{x}" for x in range(12) if x != i % 12)) for i in range(24)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.line) for r in lines.repeated_lines(d).collect()}
    assert got == _lines(docs)
    sets = [plan for name, plan in plans if name == "line-sets"]
    assert sets and not any("Join" in plan or "Aggregate" in plan for plan in sets)

    h = np.unique(np.random.default_rng(5).integers(1, 1 << 62, 4000).astype(np.uint64))
    first = np.arange(0, len(h), 100)
    rows = [(100, *(int(x) for x in m.view(np.int64))) for m in np.array(lines._parity_maps(h, first)).T.copy()]
    maps = [f"p{k}" for k in range(lines.MAPS)]
    a = spark.createDataFrame(rows, ["n", *maps])
    meet = a.crossJoin(a.toDF(*[f"by_{c}" for c in a.columns]))
    assert meet.where(lines._close(80)).count() == a.count()


def test_op8_hot_words_and_long_lines(spark, monkeypatch):
    """One word in all lines, variants of one template, long lines and rows with one id."""
    monkeypatch.setattr(lines, "CANDIDATES", 2)
    rng = np.random.default_rng(18)
    docs = []
    for i in range(70):
        template = [f"k{x}" for x in range(12)]
        template[i % 12] = f"x{i}"
        other = [f"k{x}" for x in rng.permutation(12)[:6]] + [f"y{i}x{k}" for k in range(3)]
        long = [f"L{x}" for x in range(400)]
        long[i % 7::9] = [f"m{i}x{k}" for k in range(len(long[i % 7::9]))]
        docs.append((i // 2 * 2, "\n".join([" ".join(template), " ".join(["hot", f"z{i % 30}"]), " ".join(other),
                                            " ".join(long) if i % 5 == 0 else "", "hot"])))
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    got = {(r.doc_id, r.line) for r in lines.repeated_lines(d).collect()}
    assert got == _lines(docs)


@pytest.mark.parametrize("bound", [4, 1])
def test_op8_against_brute_force(spark, trap_dir, monkeypatch, bound):
    """With a bound of one candidate the lists left behind do the rest."""
    monkeypatch.setattr(lines, "CANDIDATES", bound)
    rng = np.random.default_rng(8)
    pool = [[f"v{x}" for x in rng.integers(0, 300, rng.integers(3, 40))] for _ in range(40)]
    docs = []
    for i in range(50):
        own = []
        for _ in range(6):
            w = list(pool[rng.integers(0, 40)])
            for p in rng.integers(0, len(w), rng.integers(0, 5)):
                w[p] = f"v{rng.integers(0, 300)}"
            own.append(" ".join(w))
        docs.append((i, "\n".join(own)))
    for case in [docs, docs_of(spark, trap_dir)] + ([docs_of(spark, SF_SMALL)] if bound == 4 else []):
        d = spark.createDataFrame(case, "doc_id long, text string").repartition(4)
        got = lines.repeated_lines(d).collect()
        assert {(r.doc_id, r.line) for r in got} == _lines(case)
        assert len(got) == len({(r.doc_id, r.line) for r in got})
        assert all((r.by_doc_id, r.by_line) < (r.doc_id, r.line) for r in got)


def test_op8_text_without_its_repeated_lines(spark):
    d = spark.createDataFrame([(1, "a b c d e\nx"), (2, "x\nA b c d e\n\nz"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in lines.without_lines(d, lines.repeated_lines(d, min_words=2)).collect()}
    assert got == {1: "a b c d e\nx", 2: "x\n\nz", 3: None}
    got = {r.doc_id: r.text for r in lines.without_lines(d, lines.repeated_lines(d)).collect()}
    assert got == {1: "a b c d e\nx", 2: "\nz", 3: None}


def test_op9_held_out(spark, trap_dir):
    sf = SF_SMALL.replace("sf0.001", "sf0.1")
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = QUERIES["op9_toxicity"](spark, sf).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == (crc(r.doc_id, 5) == 0) for r in got)
    held = [(r.score, toxic[r.doc_id]) for r in got if r.held_out and r.doc_id in toxic]
    one, none = [s for s, y in held if y], [s for s, y in held if not y]
    auc = np.mean([(s > t) + (s == t) / 2 for s in one for t in none])
    assert auc > 0.85
    for r in QUERIES["op9_toxicity"](spark, trap_dir).collect():
        assert 0 <= r.score <= 1


@pytest.mark.parametrize("where", ["traps", "given"])
def test_op10_edited_texts(spark, trap_dir, where):
    sf = trap_dir if where == "traps" else SF_SMALL
    docs = docs_of(spark, sf)
    if where == "traps":  # the rank of rows with one id is not fixed by it
        docs = sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0))
    else:
        docs = sorted(docs)
    want = Counter()
    for k, (i, t) in enumerate(docs):
        t, nxt = t or "", docs[(k + 1) % len(docs)][1] or ""
        c = len(t) // 4
        want[i, len(t), hashlib.sha256((t[:len(t) - c] + nxt[:c]).encode()).hexdigest()] += 1
    got = QUERIES["op10_simhash"](spark, sf).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    if where == "given":
        assert np.mean([r.near_edited for r in got]) > np.mean([r.near_next for r in got]) + 0.4


@pytest.mark.parametrize("block", [4, 2048])
def test_near_fingerprints(spark, block):
    rng = np.random.default_rng(10)
    base = rng.integers(-2 ** 62, 2 ** 62, 30)
    fps = {int(b) ^ sum(1 << int(k) for k in set(rng.integers(0, 63, rng.integers(0, 4)).tolist()))
           for b in base for _ in range(8)}
    got = simhash.near_fingerprints(spark.createDataFrame([(f,) for f in fps] + [(None,)], "fp long"), block=block).collect()
    for r in got:
        near = [f for f in fps if f != r.fp and bin((f ^ r.fp) & (1 << 64) - 1).count("1") <= 3]
        assert (r.n_near, r.first_near) == (len(near), min([r.fp, *near]))
    assert len(got) == len(fps)


def test_components_of_chains_and_hubs(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(5, 5), (None, 3)]
    got = {r.id: r.component_id for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 160)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def _chain(rng, n, step, words=120):
    """Texts each of which changes a few words of the one before: a family whose
    ends have nothing in common."""
    text = [f"c{x}" for x in rng.integers(0, 10**6, words)]
    out = []
    for k in range(n):
        for j in rng.integers(0, words, step):
            text[j] = f"n{k}x{j}"
        out.append(" ".join(text))
    return out


def _shingle_sets(docs):
    out = []
    for i, t in docs:
        w = words(t)
        out.append((i, {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())))
    return out


@pytest.mark.parametrize("block", [16, 1024])
def test_op7_families_of_many_blocks(spark, block):
    """Chains, stars and unlinked texts that share passages, in families of over three blocks."""
    rng = np.random.default_rng(8)
    texts = _chain(rng, 90, 1) + _chain(rng, 60, 3)
    base = texts[0].split()
    for k in range(40):  # near copies of one text
        copy = list(base)
        copy[k] = f"z{k}"
        texts.append(" ".join(copy))
    shared = " ".join(f"s{x}" for x in range(40))
    texts += [shared + " " + " ".join(f"u{x}" for x in rng.integers(0, 10**6, 30)) for _ in range(60)]
    ids = rng.permutation(len(texts)).tolist()
    docs = [(int(i), t) for i, t in zip(ids, texts)]
    own = _shingle_sets(docs)
    links = [(i, j) for a, (i, x) in enumerate(own) for j, y in own[a + 1:] if 100 * len(x & y) >= 75 * len(x | y)]
    want = union(links, [i for i, _ in docs])
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), block=block)
    assert {r.doc_id: r.component_id for r in got.collect()} == want
    assert len(set(want.values())) > 60


def test_op3_and_op7_tie_all_rows_of_an_id(spark):
    a, b = BASE, " ".join(f"b{i}" for i in range(50))
    docs = spark.createDataFrame([(1, a), (2, b), (9, a), (9, b), (9, a), (5, "q r s t u v")], "doc_id long, text string")
    got = Counter((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect())
    assert got == Counter([(1, 1, True), (2, 1, False), (5, 5, True)] + [(9, 1, False)] * 3)
    x, y = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    vectors = spark.createDataFrame([(1, x), (2, y), (9, x), (9, y), (5, [0.0, 0.0, 1.0])], "vec_id long, embedding array<float>")
    got = Counter((r.vec_id, r.component_id, r.n_links) for r in caps.similar_vectors(vectors).collect())
    assert got == Counter([(1, 1, 1), (2, 1, 1), (5, 5, 0), (9, 1, 1), (9, 1, 1)])
