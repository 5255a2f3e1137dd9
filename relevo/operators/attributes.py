"""A1: ordered string aggregation of long-form attributes per product.

Per product the text is ``"name value name value ..."`` in row order
(``pos``).  Values pass through P5 first, so a missing value reads ``'nan'``.
The aggregation is two-level: rows are first folded within chunks of
``chunk`` consecutive positions, then chunks are joined in order, so no task
ever sorts more than ``chunk`` entries of one product even if one product
holds a large share of all attribute rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import nan_text

CHUNK = 4096


def _ordered_join(pos_col: str, txt_col: str):
    return F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col(pos_col), F.col(txt_col)))),
                    lambda x: x[txt_col]), " ")


def aggregate_attributes(attrs: DataFrame, key: str = "product_uid", name: str = "name",
                         value: str = "value", pos: str = "pos",
                         out: str = "product_attributes", chunk: int = CHUNK,
                         name_pattern: str | None = None) -> DataFrame:
    """``(key, out)`` with one row per key that has at least one attribute.

    ``name_pattern`` (a Java regex) keeps only matching attribute names, which
    is how the single-attribute side tables (brand/material/bullets) are cut.
    """
    a = attrs
    if name_pattern is not None:
        a = a.where(F.col(name).rlike(name_pattern))
    a = a.select(F.col(key), F.col(pos).cast("long").alias("_pos"),
                 F.concat_ws(" ", F.col(name), nan_text(value)).alias("_txt"))
    level1 = (a.groupBy(F.col(key), F.floor(F.col("_pos") / chunk).alias("_chunk"))
               .agg(F.min("_pos").alias("_first"), _ordered_join("_pos", "_txt").alias("_txt")))
    return level1.groupBy(key).agg(_ordered_join("_first", "_txt").alias(out))
