"""A training-data pipeline of five operators, from raw documents to token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next one's ``docs``.  All but the last
return the columns of ``documents``.

1. Language ID: learns from the documents that name their language, drops the
   ones it rejects (no letter, or too far from every language).
2. Line dedup: takes out repeated lines, however few words they have; a document
   that loses all its words to this goes.
3. MinHash near-dedup: one document of each group stays.
4. Mixture: cuts and repeats documents so that every source comes to its
   target, and shuffles them within their shards.
5. Byte BPE: encodes each text into packed ids, with digests of the ids and of
   what they decode to.

``n_chars``, where there is such a column, follows the text.  Null texts have
no letter and go in stage 1; rows without an id pass stages 2 and 3 as they
are; repeated rows with one id stay together; an empty table stays empty.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relevo.llm import bpe, langid, lines, minhash, mixture
from relevo.llm.common import stage, table

#: no SQL states the language model, the similarity joins or the merges
ORACLE_SQL = None


OWN = ("doc_id", "text", "lang", "source", "n_chars")


def _stage(step):
    """Extra columns travel under plain names, so none clashes with a stage's own."""

    @functools.wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        plain = [c if c in OWN else f"x{k}" for k, c in enumerate(docs.columns)]
        out = step(spark, docs.toDF(*plain), sf_dir)
        return out.toDF(*docs.columns) if out.columns == plain else out

    return run_step


def _sized(df: DataFrame) -> DataFrame:
    return df.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in df.columns else df


@_stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs, F.lit(True))
    return langid.predict(docs, model).where("not rejected").select(*docs.columns)


@_stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    removed = lines.repeated_lines(docs)
    out = lines.without_lines(docs.withColumn("_words", F.col("text").rlike(mixture.WORD)), removed)
    lost = F.col("_words") & ~F.col("text").rlike(mixture.WORD)
    return _sized(out.where(~F.coalesce(lost, F.lit(False))).drop("_words"))


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(docs)
    gone = found.where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == F.col("_gone"), "left_anti")


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _sized(mixture.mixed_documents(docs))


@_stage
def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                public_tokenizers.PATTERN, ids=True)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("mix_sources", mix_sources), ("byte_bpe", byte_bpe)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
