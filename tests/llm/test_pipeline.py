"""The pipeline's stages, one after the other, on a table full of traps."""

import subprocess
import sys
from collections import Counter

import corpus_pipeline as C
import pytest
from test_queries import trap_rows, write

import __spark_entry__ as E
from relevo.llm.common import stage


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    other = [f"t{i}" for i in range(100, 160)]  # the same words in other lines: a near copy without a repeated line
    rows = trap_rows() + [(20, " ".join(other), "en", "a", 0), (21, " ".join(other[:30]) + "\n" + " ".join(other[30:]), "en", "b", 0)]
    sf = write(spark, tmp_path_factory.mktemp("pipeline"), rows)
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, f in C.STAGES:
        out.append((name, docs, docs := stage(f(spark, docs, sf), name)))
    return sf, out


def test_order_and_registration():
    assert [n for n, _ in C.STAGES] == ["language_id", "line_dedup", "near_dedup", "mix_sources", "byte_bpe"]
    names = E.queries()
    assert "pipeline" in names and {f"op{n}" for n in range(1, 14)} <= {q.split("_")[0] for q in names}


def test_columns_stay_until_the_last_stage(steps):
    for name, before, after in steps[1][:-1]:
        assert after.columns == before.columns, name
        if name != "language_id":
            assert after.where("n_chars <> char_length(text)").count() == 0


def test_decisions_take_effect(steps):
    ids = {name: Counter(r.doc_id for r in after.collect()) for name, _, after in steps[1]}
    assert set(ids["language_id"]) == {1, 2, 3, 7, 8, 9, 11, 12, 13, 20, 21, None}
    # 2 and 3 lose their only line to 1, 9 its two words to 8; the line of 12 goes, the rest of it stays
    assert not {2, 3, 9} & set(ids["line_dedup"]) and {1, 7, 8, 12, 20, 21, None} <= set(ids["line_dedup"])
    lines_ = {r.doc_id: r.text for r in dict((n, a) for n, _, a in steps[1])["line_dedup"].collect()}
    assert lines_[12] == "x\ny z"
    assert set(ids["line_dedup"]) - set(ids["near_dedup"]) == {21}
    assert set(ids["mix_sources"]) <= set(ids["near_dedup"])
    assert sum(ids["byte_bpe"].values()) == sum(ids["mix_sources"].values())


def test_run_is_the_stages(spark, steps):
    sf, out = steps
    want = Counter((r.doc_id, r.ids_sha256) for r in out[-1][2].collect())
    assert Counter((r.doc_id, r.ids_sha256) for r in C.run(spark, sf).collect()) == want


def test_empty_table(spark, tmp_path):
    assert C.run(spark, write(spark, tmp_path, [])).collect() == []


def test_the_library_does_without_the_subpackage():
    code = ("import sys; sys.modules['relevo.llm'] = None; import __spark_entry__ as e; "
            "assert 'pipeline' not in e.queries() and len(e.queries()) > 50")
    subprocess.run([sys.executable, "-c", code], check=True)
