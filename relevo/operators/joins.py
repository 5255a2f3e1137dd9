"""Joins of the reference: J1 (pairs ⟕ product text), J2 (product dimension
chain), J3 (⟕ aggregated attributes) and U1 (train ∪ test).

Every join is a left equi-join on ``product_uid``.  The plan states the join
declaratively; AQE picks broadcast (only when the runtime size of a side is
under ``spark.sql.adaptive.autoBroadcastJoinThreshold``) or sort-merge, and
splits skewed partitions of a hot ``product_uid``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import fill_text


def left_join(left: DataFrame, right: DataFrame, key: str = "product_uid",
              null_safe: bool = False) -> DataFrame:
    """``pd.merge(left, right, how='left', on=key)``.

    ``null_safe=True`` matches null keys with null keys as pandas does.
    """
    if not null_safe:
        return left.join(right, key, "left")
    r = right.withColumnRenamed(key, "_rk")
    j = left.join(r, left[key].eqNullSafe(r["_rk"]), "left")
    return j.drop("_rk")


def product_dimension(descriptions: DataFrame, bullets: DataFrame | None = None,
                      brand: DataFrame | None = None, material: DataFrame | None = None,
                      key: str = "product_uid", keep_desc: bool = False) -> DataFrame:
    """Description ⟕ bullets ⟕ brand ⟕ material.

    The description becomes ``description + ' ' + bullets``; like the
    reference, a product without bullets loses its description (null) unless
    ``keep_desc`` is set.
    """
    d = descriptions
    if bullets is not None:
        d = d.join(bullets, key, "left")
        joined = F.concat(F.col("product_description"), F.lit(" "), F.col("bullets"))
        if keep_desc:
            joined = F.coalesce(joined, F.col("product_description"))
        d = d.withColumn("product_description", joined).drop("bullets")
    for side in (brand, material):
        if side is not None:
            d = d.join(side, key, "left")
    return d


def with_attributes(pairs: DataFrame, product_attributes: DataFrame,
                    key: str = "product_uid", col: str = "product_attributes") -> DataFrame:
    """Pairs ⟕ aggregated attributes, missing text filled with ''."""
    return (pairs.join(product_attributes, key, "left")
            .withColumn(col, fill_text(col, "")))


def union_all(*frames: DataFrame) -> DataFrame:
    """Row union by column name; columns missing on one side are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
