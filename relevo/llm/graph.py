"""Connected components of a link table, as joins and aggregations.

Alternating large-star and small-star steps: each turn hooks every node to
the smallest node it knows, so chains shrink by halves.  The links are staged
after each turn; nothing is collected but two counters.  A hub's links are
pre-aggregated before the shuffle, and the join back may be split by the
engine where a hub is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _signature(df: DataFrame) -> tuple:
    r = df.agg(F.count(F.lit(1)).alias("n"),
               F.sum(F.xxhash64("u", "v") % 1_000_000_007).alias("s")).first()
    return r.n, r.s


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component_id)`` of every linked id; ``component_id`` is the
    smallest id reachable.  Self-links and nulls are ignored, repeats allowed.
    """
    e = (links.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
         .where(f"{a} is not null and {b} is not null and u <> v").distinct())
    e = stage(e, "links")
    seen = _signature(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        # u -> its smallest v; its other v's hook to the same one
        hooked = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stage(least.select("u", F.col("m").alias("v")).unionByName(hooked).distinct(), "links")
        now = _signature(e)
        if now == seen:
            break
        seen = now
    own = e.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    return e.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionByName(own)
