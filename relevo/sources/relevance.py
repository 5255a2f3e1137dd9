"""The reference's logical tables, derived from the given test tables.

Mapping (fixed by the blueprint): one search--product pair per document,
``id = doc_id``, and three documents in a row share the first one's product
(``product_uid = doc_id - doc_id % 3``); the search term is the whole text of the
benchmark item ``doc_id % count(benchmark)``; the product title is the first line
of the product's document (empty where there is none); the grade is
``1 + quality + (1 - toxic)`` from ``labels`` and unlabelled documents form the
test side.  Product
description = document text, brand = ``source`` (``src0`` names no brand: null),
material = ``lang``; the long-form attribute table unpivots ``part`` (brand,
type, size).

All of these are lazy plans over the scans: nothing is materialised here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, product_uid, product_title, search_term, relevance)``; relevance
    is null on the test side (U1: train ∪ test)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    bench = read_table(spark, sf_dir, "benchmark")
    n_items = bench.select(F.count(F.lit(1))).scalar()
    terms = bench.select("item_id", F.col("text").alias("search_term"))
    titles = read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("product_uid"), F.substring_index("text", "\n", 1).alias("product_title"))
    labels = read_table(spark, sf_dir, "labels").select(
        "doc_id",
        (F.lit(1.0) + F.col("quality").cast("double")
         + (F.lit(1.0) - F.col("toxic").cast("double"))).alias("relevance"))
    base = docs.select(
        F.col("doc_id").alias("id"),
        (F.col("doc_id") - F.col("doc_id") % 3).alias("product_uid"),
        F.pmod(F.col("doc_id"), n_items).alias("item_id"))
    return (base.join(terms, "item_id", "left")
            .join(titles, "product_uid", "left")
            .withColumn("product_title", F.coalesce("product_title", F.lit("")))
            .join(labels.withColumnRenamed("doc_id", "id"), "id", "left")
            .select("id", "product_uid", "product_title", "search_term", "relevance"))


def train_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(spark, sf_dir).where(F.col("relevance").isNotNull())


def test_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(spark, sf_dir).where(F.col("relevance").isNull()).drop("relevance")


def product_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(product_uid, product_description)``."""
    return read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("product_uid"), F.col("text").alias("product_description"))


# Attribute names of the unpivoted ``part`` table, in row order.
ATTRIBUTE_COLUMNS = (("brand", "p_brand"), ("type", "p_type"), ("size", "p_size"))


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-form attributes ``(product_uid, name, value, pos)``; ``pos`` is the
    row order the reference gets implicitly from the file."""
    part = read_table(spark, sf_dir, "part")
    stack = ", ".join(f"{i}, '{n}', cast({c} as string)"
                      for i, (n, c) in enumerate(ATTRIBUTE_COLUMNS))
    return part.selectExpr(
        "p_partkey as product_uid",
        f"stack({len(ATTRIBUTE_COLUMNS)}, {stack}) as (pos, name, value)")


def source_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(product_uid, brand)`` with every document's source as it is, ``src0`` too."""
    return read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("product_uid"), F.col("source").alias("brand"))


def attr_side_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three side tables of the attribute flow: brand, material, bullets.

    brand/material come from the document's ``source``/``lang``; bullets are
    the aggregated attribute text (A1) of the product.
    """
    from ..operators.attributes import aggregate_attributes

    docs = read_table(spark, sf_dir, "documents")
    return {
        "brand": docs.select(F.col("doc_id").alias("product_uid"), F.nullif("source", F.lit("src0")).alias("brand")),
        "material": docs.select(F.col("doc_id").alias("product_uid"), F.col("lang").alias("material")),
        "bullets": aggregate_attributes(attributes(spark, sf_dir), out="bullets"),
    }
