"""stem text columns with the Snowball English algorithm.

``lower -> split -> stem each word -> join by one blank``.  Two plans with one
result:

* ``method="inline"`` (default): a vectorised (Arrow) UDF rewrites each
  text where it lies, with a bounded memo of word -> stem in each Python
  worker, and no token is shuffled.  Whitespace splitting and lower-casing stay
  in Spark expressions; texts come as strings, and ``SLICE`` of a batch at a
  time are Python objects, so a worker holds little more than the batch.
* ``method="vocabulary"``: each distinct word of the corpus is stemmed once in
  the whole cluster, but every token is shuffled twice (join back, regroup),
  which costs more than the Python work it saves on long texts; for corpora
  with a small vocabulary.

The vocabulary job:

1. explode every text into ``(row, field, pos, word)``;
2. take the *distinct* words of the corpus and stem them once each in an
   Arrow (pandas) UDF -- the only Python in the plan, and it sees the
   vocabulary, not the tokens;
3. join the stems back on ``word`` (AQE broadcasts the vocabulary side only
   when its runtime size is under the threshold, and splits hot words);
4. rebuild each text in two levels: chunks of ``CHUNK`` positions, then the
   chunks in order, so no task sorts all words of a long text.

Null texts stay null; texts without words become ''.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .porter2 import stem as stem_word
from .text import words


_MEMO: dict[str, str] = {}
_MEMO_MAX = 100_000
CHUNK = 4096
SLICE = 64


def _stem_cached(w: str) -> str:
    r = _MEMO.get(w)
    if r is None:
        if len(_MEMO) >= _MEMO_MAX:
            _MEMO.clear()
        r = _MEMO[w] = stem_word(w)
    return r


def _stem_text(text: str | None) -> str | None:
    return " ".join([_stem_cached(w) for w in text.split(" ")]) if text else text


def _stem_texts(texts: pa.Array) -> pa.Array:
    """Texts of words with a blank between, stemmed; ``SLICE`` of them at a time."""
    parts = [pa.array([_stem_text(t) for t in texts.slice(lo, SLICE).to_pylist()], pa.string())
             for lo in range(0, len(texts), SLICE)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


@F.arrow_udf(T.StringType())
def _stem_words_udf(texts: pa.Array) -> pa.Array:
    return _stem_texts(texts)


def stem_text(c) -> "F.Column":
    """Stemmed text of a column (null stays null, no words gives '')."""
    col = F.col(c) if isinstance(c, str) else c
    return _stem_words_udf(F.array_join(words(F.lower(col)), " "))


@F.pandas_udf(T.StringType())
def _stem_word_udf(word: pd.Series) -> pd.Series:
    return word.map(stem_word)


def _stem_by_vocabulary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    from ..sources.csvio import stage
    rows = stage(df.withColumn("_row", F.monotonically_increasing_id()), "stem-rows")
    each = [rows.select("_row", F.lit(c).alias("field"), F.posexplode(words(F.lower(F.col(c)))).alias("pos", "word"))
            for c in cols]
    tokens = each[0]
    for part in each[1:]:
        tokens = tokens.unionByName(part)
    vocabulary = stage(tokens.select("word").distinct().withColumn("stem", _stem_word_udf("word")), "stems")
    text = ["_row", "field"]

    def ordered(by: str, what: str):
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(by, what))), lambda x: x[what]), " ")

    chunks = (tokens.join(vocabulary, "word").groupBy(*text, F.floor(F.col("pos") / CHUNK).alias("chunk"))
              .agg(ordered("pos", "stem").alias("part")))
    texts = chunks.groupBy(*text).agg(ordered("chunk", "part").alias("text"))
    wide = texts.groupBy("_row").agg(*[F.max(F.when(F.col("field") == c, F.col("text"))).alias(f"_stem_{i}")
                                       for i, c in enumerate(cols)])
    out = rows.join(wide, "_row", "left")
    done = {c: F.when(F.col(c).isNotNull(), F.coalesce(f"_stem_{i}", F.lit(""))) for i, c in enumerate(cols)}
    return out.withColumns(done).select(*df.columns)


def stem_columns(df: DataFrame, cols: Sequence[str], method: str = "inline") -> DataFrame:
    """``df`` with each of ``cols`` replaced by its stemmed text."""
    if method == "vocabulary":
        return _stem_by_vocabulary(df, cols)
    return df.withColumns({c: stem_text(c) for c in cols})
