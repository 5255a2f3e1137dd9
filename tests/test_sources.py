"""The pairs view against a plain-Python reading of the mapping rules."""

import pyarrow as pa
import pyarrow.parquet as pq

from conftest import SF_SMALL
from __spark_entry__ import queries
from relevo.sources.relevance import attributes, pairs


def test_pairs_view_follows_the_mapping(spark):
    docs = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()
    bench = {r["item_id"]: r["text"] for r in pq.read_table(f"{SF_SMALL}/benchmark.parquet").to_pylist()}
    labels = {r["doc_id"]: r for r in pq.read_table(f"{SF_SMALL}/labels.parquet").to_pylist()}
    names = {r["p_partkey"]: r["p_name"] for r in pq.read_table(f"{SF_SMALL}/part.parquet").to_pylist()}
    want = {}
    for d in docs:
        i = d["doc_id"]
        lab = labels.get(i)
        want[i] = (i - i % 3, bench[i % len(bench)], names.get(i - i % 3, ""),
                   None if lab is None else 1.0 + lab["quality"] + (1 - lab["toxic"]))
    got = {r["id"]: (r["product_uid"], r["search_term"], r["product_title"], r["relevance"])
           for r in pairs(spark, SF_SMALL).collect()}
    assert got == want
    assert sum(v[3] is None for v in got.values()) > 0          # a test side exists


def test_attributes_unpivot_in_row_order(spark):
    part = pq.read_table(f"{SF_SMALL}/part.parquet").to_pylist()[:3]
    got = {}
    for r in attributes(spark, SF_SMALL).collect():
        got.setdefault(r["product_uid"], []).append((r["pos"], r["name"], r["value"]))
    for p in part:
        assert sorted(got[p["p_partkey"]]) == [(0, "brand", p["p_brand"]), (1, "type", p["p_type"]),
                                               (2, "size", str(p["p_size"]))]


def _documents(tmp_path, rows):
    """Tables of a few documents ``(doc_id, text, lang, source)``, each with a label, and of one item."""
    ids, texts, langs, sources = zip(*rows)
    whole = pa.int64()
    for name, columns in {
            "documents": {"doc_id": pa.array(ids, whole), "text": list(texts), "lang": list(langs), "source": list(sources),
                          "n_chars": pa.array([len(t or "") for t in texts], whole)},
            "benchmark": {"item_id": pa.array([0], whole), "text": ["src0 one"]},
            "labels": {"doc_id": pa.array(ids, whole), "quality": pa.array([1] * len(ids), pa.int32()),
                       "toxic": pa.array([0] * len(ids), pa.int32())},
            "part": {"p_partkey": pa.array(ids, whole), "p_name": ["n"] * len(ids), "p_brand": ["b"] * len(ids),
                     "p_type": ["t"] * len(ids), "p_size": pa.array([1] * len(ids), pa.int32()),
                     "p_retailprice": [1.0] * len(ids)}}.items():
        pq.write_table(pa.table(columns), tmp_path / f"{name}.parquet")
    return str(tmp_path)


def test_side_table_keeps_every_named_source(spark, tmp_path):
    sf = _documents(tmp_path, [(0, "a", "en", "src0"), (3, "b", "en", "src1"), (6, "c", "en", None)])
    got = {(r["product_uid"], r["brand"]) for r in queries()["S3_side_table_dropna"](spark, sf).collect()}
    assert got == {(0, "src0"), (3, "src1")}


def test_edit_ratios_of_titles_and_of_every_named_source(spark, tmp_path):
    sf = _documents(tmp_path, [(0, "src0 one\nmore", "en", "src0"), (3, "xyz", None, None)])
    got = {r["id"]: r for r in queries()["F5_edit_ratio"](spark, sf).collect()}
    assert got[0]["dist_in_title"] == 1.0 and got[0]["dist_in_brand"] == round(8 / 12, 6)
    assert got[3]["dist_in_title"] == 0.0 and got[3]["dist_in_brand"] == round(2 / 9, 6)
