"""Substring deduplication by hashed units (operator 2).

Method: every line is normalised (words, ``A-Z`` lower-cased) and hashed; all
digests are grouped, the earliest ranked occurrence (smallest id, then place)
is kept and the others are removed, with their offsets in the original text.
A line is too coarse a unit for a passage pasted into the middle of one, so
lines are cut further where the text itself says so: before a word whose
bigram hash is the least among its ``reach`` neighbours on either side.  The
cuts inside a repeated passage are then the same wherever it stands.
Neighbouring repeated units are joined to a run, and only runs of at least
``min_words`` words go, so a short phrase that recurs by chance inside a line
stays.  Whole lines are grouped by a digest of their own as well, and later
copies go whatever their length.

Defined results: a null or empty text has no units; a row without an id can't
be ranked and takes no part; rows that share an id count as one document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Batches
from .words import U, Words, _power_tables, blocks, mix

REACH = 3
MIN_WORDS = 20
_LINE = U(0xA24BAED4963EE407)


def unit_starts(w: Words, h: np.ndarray, reach: int = REACH) -> np.ndarray:
    """Indices of the words that begin a unit, in order."""
    n = len(h)
    if not n:
        return np.zeros(0, np.int64)
    bigram = mix(h + np.r_[h[1:], U(0)] * U(0x9E3779B97F4A7C15))
    cut = np.ones(n, bool)
    for d in range(1, reach + 1):
        if d < n:
            cut[d:] &= bigram[d:] < bigram[:-d]
            cut[:-d] &= bigram[:-d] <= bigram[d:]
    newline = np.flatnonzero(w.data == 10)
    line = np.searchsorted(newline, w.start)
    cut[1:] |= line[1:] != line[:-1]
    first = w.ptr[:-1]
    cut[first[first < w.ptr[1:]]] = True
    return np.flatnonzero(cut)


def _units(batches: Batches) -> Batches:
    for b in batches:
        ids = b.column(0).to_numpy(zero_copy_only=False)
        for w in blocks(b.column(1)):
            if not len(w):
                continue
            h = w.hashes()
            s = unit_starts(w, h)
            e = np.r_[s[1:], len(h)]
            power, inverse = _power_tables(len(h) + 1)
            total = np.zeros(len(h) + 1, U)
            np.cumsum(h * power[:len(h)], out=total[1:])
            digest = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(U))
            row = w.rows()[s]
            no = np.arange(len(s)) - np.searchsorted(s, w.ptr[:-1])[row]
            number = np.searchsorted(np.flatnonzero(w.data == 10), w.start[s])
            first = np.flatnonzero(np.r_[True, (number[1:] != number[:-1]) | (row[1:] != row[:-1])])
            of = np.diff(np.r_[first, len(s)])  # units of each line
            line = np.repeat(no[first], of)
            # the lines themselves, after the units
            a, z = s[first], e[first + of - 1]
            whole = mix(mix((total[z] - total[a]) * inverse[a] + (z - a).astype(U)) ^ _LINE)
            digest, of = np.r_[digest, whole], np.r_[np.zeros(len(s), np.int64), of]
            s, e, row, no, line = (np.r_[x, y] for x, y in ((s, a), (e, z), (row, row[first]), (no, no[first]),
                                                           (line, no[first])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(digest.view(np.int64)), pa.array(ids[w.lo + row]), pa.array(no.astype(np.int32)),
                 pa.array(w.chars(w.start[s]).astype(np.int32)), pa.array(w.chars(w.end[e - 1]).astype(np.int32)),
                 pa.array((e - s).astype(np.int32)), pa.array(line.astype(np.int32)), pa.array(of.astype(np.int32))],
                names=["digest", "doc_id", "unit", "start", "end", "words", "line", "units"])


def units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole_lines: bool = False) -> DataFrame:
    """The units of all texts: ``digest``, ``doc_id``, ``unit`` (from 0),
    ``start``/``end`` (code points), ``words`` and ``line`` (its line's first
    unit); with ``whole_lines`` also one row a line (``units``: how many it has,
    else 0), which is named by its first unit."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where(
        "doc_id is not null and text is not null")
    out = rows.mapInArrow(_units, "digest long, doc_id long, unit int, start int, `end` int, words int, line int, units int")
    return out if whole_lines else out.where("units = 0")


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_words: int = MIN_WORDS, whole_lines: bool = False) -> DataFrame:
    """The runs to remove: ``doc_id``, ``start``, ``end`` (code points of the
    original text), ``n_words``, ``n_units`` and ``first_doc_id`` /
    ``first_start``, where the run's first unit is kept.  With ``whole_lines``
    repeated lines of any length are removed too, and joined to the runs beside
    them."""
    u = units(docs, id_col, text_col, whole_lines)
    first = (u.groupBy("digest").agg(F.count(F.lit(1)).alias("n"),
                                     F.min(F.struct("doc_id", "unit", "start")).alias("first"))
             .where("n > 1").select("digest", "first"))
    repeats = u.join(first, "digest").where(
        "not (doc_id = first.doc_id and unit = first.unit)").drop("digest")
    # a document's repeated units in order; consecutive numbers form a run
    whole = F.col("units") > 0
    own = (repeats.withColumn("whole", whole).dropDuplicates(["doc_id", "unit", "whole"])
           .withColumn("run", F.col("unit") - F.row_number().over(Window.partitionBy("doc_id", "whole").orderBy("unit")))
           .withColumn("run_words", F.sum("words").over(Window.partitionBy("doc_id", "whole", "run")))
           .where(F.col("whole") | (F.col("run_words") >= min_words))
           # a repeated line stands for its units
           .withColumn("covered", F.max("whole").over(Window.partitionBy("doc_id", "line")))
           .where(F.col("whole") | ~F.col("covered")).withColumn("units", F.greatest("units", F.lit(1))))
    w = Window.partitionBy("doc_id").orderBy("unit")
    run = own.withColumn("run", F.col("unit") - F.coalesce(
        F.sum("units").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return run.groupBy("doc_id", "run").agg(
        F.min("start").cast("long").alias("start"), F.max("end").cast("long").alias("end"),
        F.sum("words").alias("n_words"), F.sum("units").alias("n_units"),
        F.min(F.struct("unit", "first")).getField("first").alias("first")).select(
        "doc_id", "start", "end", "n_words", "n_units", F.col("first.doc_id").alias("first_doc_id"),
        F.col("first.start").cast("long").alias("first_start"))


def remove_runs(docs: DataFrame, runs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the runs cut out of their texts; other columns stay."""
    spans = runs.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_spans"))
    d = docs.join(spans.withColumnRenamed("doc_id", "_run_id"), F.col(id_col).cast("long") == F.col("_run_id"), "left")
    # the parts between the spans, put together
    cut = F.expr(f"""CASE WHEN _spans IS NULL THEN `{text_col}` ELSE concat_ws('', transform(
        sequence(0, size(_spans)), k -> substring(`{text_col}`,
            cast(CASE WHEN k = 0 THEN 1 ELSE _spans[k - 1].end + 1 END AS int),
            cast(CASE WHEN k = size(_spans) THEN char_length(`{text_col}`) ELSE _spans[k].start END
                 - CASE WHEN k = 0 THEN 0 ELSE _spans[k - 1].end END AS int)))) END""")
    return d.withColumn(text_col, cut).select(*docs.columns)
