"""The thin ``opN_*`` queries: each applies its operator, with production
parameters, to its whole table and returns the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, caps, langid, lines, lm, minhash, mixture, quality, repeats, runs, search, simhash, toxicity
from .common import fold, stage, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op2_substring_dedup(spark, sf):
    return repeats.repeated_runs(table(spark, sf, "documents"), whole_lines=True)


@register
def op4_mixture(spark, sf):
    return mixture.mix_sources(table(spark, sf, "documents")).select(
        "doc_id", "size", "source_size", "target", mixture.taken().alias("taken"))


@register
def op5_byte_bpe(spark, sf):
    return bpe.encode_documents(table(spark, sf, "documents"),
                                public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@register
def op6_language_id(spark, sf):
    docs = table(spark, sf, "documents")
    model = langid.fit(docs, fold("doc_id", 4) != 2)
    out = langid.predict(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return out.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


@register
def op9_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    model = toxicity.fit(docs, table(spark, sf, "labels"), fold("doc_id", 5) != 0)
    out = toxicity.score_documents(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return out.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))


@register
def op10_simhash(spark, sf):
    fp = simhash.edited_fingerprints(table(spark, sf, "documents"))
    near = simhash.near_fingerprints(fp.select("fp"))
    return fp.join(near, "fp").select(
        "doc_id", "n_chars", "edited_sha256", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.lpad(F.lower(F.hex("edited_fp")), 16, "0").alias("edited_fingerprint"),
        simhash.likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        simhash.likeness(F.col("fp"), F.col("next_fp")).alias("near_next"), "n_near")


@register
def op7_minhash_near_dedup(spark, sf):
    return minhash.near_duplicates(table(spark, sf, "documents"))


@register
def op3_embedding_caps(spark, sf):
    return caps.similar_vectors(table(spark, sf, "embeddings"))


@register
def op1_bloom_lm(spark, sf):
    docs = table(spark, sf, "documents")
    model, texts = lm.fit(docs, fold("doc_id", 5) != 1, fold("doc_id", 5) == 1)
    return lm.score_documents(texts, model)


@register
def op8_line_dedup(spark, sf):
    return lines.repeated_lines(table(spark, sf, "documents"))


@register
def op11_quality(spark, sf):
    stats = stage(quality.document_statistics(table(spark, sf, "documents")), "statistics")
    model = quality.fit(stats, table(spark, sf, "labels"), fold("doc_id", 5) != 0)
    return quality.scored(stats, model).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@register
def op12_ranked_search(spark, sf):
    return search.ranked_documents(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


ORACLE_SQL["op12_ranked_search"] = r"""
WITH terms AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
docs AS (SELECT doc_id, ts, CAST(len(ts) AS BIGINT) AS n FROM terms WHERE len(ts) > 0),
size AS (SELECT count(*) AS N_, CAST(sum(n) AS BIGINT) AS L_ FROM docs),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tf AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(ts) AS term FROM docs)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * N_ + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, size GROUP BY term, N_),
part AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * N_) // L_))) AS x
  FROM tf JOIN weight USING (term), size),
total AS (SELECT item_id, doc_id, CAST(sum(x) AS BIGINT) AS score FROM wanted JOIN part USING (term) GROUP BY ALL),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM total WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""


@register
def op13_periodic_runs(spark, sf):
    found = runs.periodic_runs(runs.with_repeats(table(spark, sf, "documents").select("doc_id", "text")), ["doc_id"], digest=True)
    best = F.col("best")
    lines_ = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"),
                                                    F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("best", runs.strongest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), ((1000 * best["length"] - (1000 * best["length"]) % best["period"]) / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines_, "").cast("binary"), 256).alias("runs_sha256"),
        F.col("collapsed").alias("collapsed_sha256"))
