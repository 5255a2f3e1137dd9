"""F2 stems (published vocabulary pairs) and F5 on whole texts vs a DP."""

import random

import pytest
from pyspark.sql import functions as F

from relevo.functions.edit import edit_ratio
from relevo.functions.porter2 import stem
from relevo.functions.stem import stem_columns

# Pairs from the published Snowball English sample vocabulary.
VOCAB = {
    "consign": "consign", "consigned": "consign", "consigning": "consign",
    "consignment": "consign", "consist": "consist", "consisted": "consist",
    "consistency": "consist", "consistent": "consist", "consistently": "consist",
    "consolation": "consol", "consolatory": "consolatori", "consolidate": "consolid",
    "consolingly": "consol", "conspicuously": "conspicu", "conspiracy": "conspiraci",
    "constancy": "constanc", "knackeries": "knackeri", "kneeling": "kneel",
    "knightly": "knight", "knitting": "knit", "knives": "knive", "generously": "generous",
    "skies": "sky", "dying": "die", "news": "news", "cries": "cri", "ties": "tie",
    "hopping": "hop", "agreed": "agre", "relational": "relat", "sensibiliti": "sensibl",
    "triplicate": "triplic", "effective": "effect", "adoption": "adopt",
    "succeeding": "succeed", "installation": "instal", "lighting": "light",
}


@pytest.mark.parametrize("word,want", sorted(VOCAB.items()))
def test_porter2_vocabulary(word, want):
    assert stem(word) == want


def test_vocabulary_job_equals_inline_on_all_documents(spark, monkeypatch):
    from conftest import SF_SMALL
    from relevo.functions import stem as stem_module
    monkeypatch.setattr(stem_module, "CHUNK", 50)
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "source")
    extra = spark.createDataFrame([(-1, None, "Runs"), (-2, " ", None), (-2, " ", None)], d.schema)
    d = d.unionByName(extra)
    one, two = (sorted(map(tuple, stem_columns(d, ["text", "source"], method=m).collect()), key=repr)
                for m in ("inline", "vocabulary"))
    assert one == two and len(one) == d.count()


def test_stem_job_equals_per_word(spark):
    rows = [(1, "Lighting  Installations for KNIGHTLY consoles"), (2, " "), (3, None),
            (4, "running running runs")]
    df = spark.createDataFrame(rows, "k long, t string")
    got = {r["k"]: r["t"] for r in stem_columns(df, ["t"]).collect()}
    for k, t in rows:
        want = None if t is None else " ".join(stem(w) for w in t.lower().split())
        assert got[k] == want


def _lcs(a, b):
    prev = [0] * (len(b) + 1)
    for x in a:
        cur = [0]
        for j, y in enumerate(b):
            cur.append(prev[j] + 1 if x == y else max(prev[j + 1], cur[j]))
        prev = cur
    return prev[-1]


def test_edit_ratio_whole_texts_vs_dp(spark):
    from conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text") \
        .orderBy("doc_id").limit(6).collect()
    rnd = random.Random(0)
    rows = [(d["doc_id"], " ".join(rnd.sample(d["text"].split(), 4)), d["text"]) for d in docs]
    df = spark.createDataFrame(rows, "id long, q string, t string")
    got = {r["id"]: r["r"] for r in df.select("id", edit_ratio("q", "t").alias("r")).collect()}
    for i, q, t in rows:
        assert got[i] == pytest.approx(2 * _lcs(q, t) / (len(q) + len(t)))


def test_stemming_holds_a_slice_of_a_batch_as_objects():
    """Before, all words of a batch were Python objects at once: some 25 times the texts."""
    import tracemalloc

    import pyarrow as pa

    from relevo.functions.stem import _stem_texts
    texts = pa.array([" ".join(f"running{(i * j) % 97}" for j in range(400)) for i in range(4000)] + [None, ""])
    _stem_texts(texts.slice(0, 100))
    tracemalloc.start()
    got = _stem_texts(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.slice(4000).to_pylist() == [None, ""] and len(got) == 4002
    assert peak < texts.nbytes / 4
