"""Unit rows for the traps (FIXTURES §4) on the column expressions."""

import math

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from relevo.functions import (alpha_tokens, clip_both, clip_upper, fill_text, nan_text,
                              normalise, overlap_count, sentences, word_count, word_tokens)
from relevo.functions.edit import edit_ratio, ratio


def one(spark, expr, **cols):
    df = spark.createDataFrame([Row(**cols)]) if cols else spark.range(1)
    return df.select(expr.alias("v")).first()["v"]


@pytest.mark.parametrize("a,b,want", [("kitten", "sitting", 8 / 13), ("ab", "ba", 0.5),
                                      ("", "", 1.0), ("abc", "", 0.0)])
def test_edit_ratio_cases(spark, a, b, want):
    assert ratio(a, b) == pytest.approx(want)
    got = spark.createDataFrame([(a, b)], "a string, b string").select(
        edit_ratio("a", "b").alias("r")).first()["r"]
    assert got == pytest.approx(want)


def test_overlap_is_substring_and_counts_duplicates(spark):
    assert one(spark, overlap_count("w", "t"), w="angle bracket an an", t="rectangle") == 3
    assert one(spark, overlap_count("w", "t"), w=" ", t="rectangle") == 0


def test_word_count_and_normalise(spark):
    assert one(spark, word_count("s"), s="  a  b ") == 2
    assert one(spark, normalise("s"), s="  Angle\tBRACKET \n x ") == "angle bracket x"


def test_alpha_tokens(spark):
    got = one(spark, alpha_tokens("s"), s="12-gauge x 3/4in. angle_1 éab c3po")
    assert got == ["gauge", "x", "in", "angle_", "éab", "c", "po"]


def test_word_tokens_and_sentences(spark):
    assert one(spark, word_tokens("s"), s="Hi, you.") == ["Hi", ",", "you", "."]
    assert one(spark, sentences("s"), s="One two. Three!  Four?") == ["One two.", "Three!", "Four?"]


def test_null_concat_then_fill(spark):
    df = spark.createDataFrame([("a", None)], "d string, b string")
    row = df.select(F.concat("d", F.lit(" "), "b").alias("c")).select(
        "c", fill_text("c", " ").alias("f")).first()
    assert row["c"] is None and row["f"] == " "


def test_nan_text(spark):
    df = spark.createDataFrame([(None,), ("x",)], "b string")
    assert [r["v"] for r in df.select(nan_text("b").alias("v")).collect()] == ["nan", "x"]


def test_clip(spark):
    df = spark.createDataFrame([(3.4,), (0.2,), (float("nan"),), (None,)], "p double")
    both = [r["v"] for r in df.select(clip_both("p").alias("v")).collect()]
    up = [r["v"] for r in df.select(clip_upper("p").alias("v")).collect()]
    assert both[:2] == [3.0, 1.0] and math.isnan(both[2]) and both[3] is None
    assert up[:2] == [3.0, 0.2] and math.isnan(up[2])


def test_quoted_latin1_csv_roundtrip(spark, tmp_path):
    from relevo.sources.csvio import read_csv
    p = tmp_path / "t.csv"
    p.write_bytes('id,txt\n1,"café, 3"" x"\n'.encode("latin-1"))
    df = read_csv(spark, str(p), "id long, txt string")
    assert df.first()["txt"] == 'café, 3" x'


@pytest.mark.parametrize("s", ["", "   ", "one", "  lead two", "a b c d e", "a b c d ",
                               "a b c d e f g", "\nx\ty  z\n w ", "w1 w2 w3 w4 w5"])
def test_first_words_matches_split_semantics(spark, s):
    from relevo.functions.text import first_words
    for n in (1, 4):
        assert one(spark, first_words("s", n), s=s) == " ".join(s.split()[:n])
