"""Parquet scans of the given tables with declared schemas (no inference pass)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

L, I, D, S = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SCHEMAS: dict[str, T.StructType] = {
    "documents": _st(("doc_id", L), ("text", S), ("lang", S), ("source", S), ("n_chars", L)),
    "benchmark": _st(("item_id", L), ("text", S)),
    "labels": _st(("doc_id", L), ("quality", I), ("toxic", I)),
    "part": _st(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S),
                ("p_size", I), ("p_retailprice", D)),
    "embeddings": _st(("vec_id", L), ("embedding", T.ArrayType(T.FloatType(), True)),
                      ("label", I)),
    "lineitem": _st(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L),
                    ("l_linenumber", I), ("l_quantity", D), ("l_extendedprice", D),
                    ("l_discount", D), ("l_tax", D), ("l_returnflag", S),
                    ("l_linestatus", S), ("l_shipdate", T.TimestampType())),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan ``{sf_dir}/{name}.parquet``; declared schema when we know it."""
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))
