"""Helpers shared by the operators: documents, staged tables, bounded count
tables summed over all partitions, and pairs of a bucket's blocks."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: the
    lineage ends there, and a lost executor's tasks read files again."""
    path = scratch_path(df.sparkSession, name)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def fold(id_col: str | Column, n: int) -> Column:
    """``crc32(id as text) mod n``; a row without an id has none (null)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(c.cast("string").cast("binary")) % n


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def summed_tables(df: DataFrame, fill: Callable[[pa.RecordBatch, np.ndarray], None],
                  shape: tuple[int, ...], segments: int = 32) -> DataFrame:
    """Sum one count table of a fixed shape over all rows of ``df``.

    ``fill(batch, counts)`` adds a batch to its task's own int64 table.  Each
    task sends its table once, in ``segments`` compressed pieces; pieces of one
    segment are added up as they stream in.  Rows: ``seg int, part binary``.
    The size is fixed by ``shape``, whatever the input.
    """
    import zlib

    def local(batches: Batches) -> Batches:
        counts = np.zeros(shape, np.int64)
        for b in batches:
            fill(b, counts)
        flat = counts.reshape(-1)
        cuts = np.linspace(0, len(flat), segments + 1).astype(int)
        seg = [k for k in range(segments) if flat[cuts[k]:cuts[k + 1]].any()]
        yield pa.RecordBatch.from_pydict({
            "seg": pa.array(seg, pa.int32()),
            "part": pa.array([zlib.compress(flat[cuts[k]:cuts[k + 1]].tobytes(), 1)
                              for k in seg], pa.binary())})

    def add(batches: Batches) -> Batches:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, part in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = np.frombuffer(zlib.decompress(part), np.int64)
                total[k] = total[k] + x if k in total else x
        yield pa.RecordBatch.from_pydict({
            "seg": pa.array(list(total), pa.int32()),
            "part": pa.array([zlib.compress(x.tobytes(), 1) for x in total.values()],
                             pa.binary())})

    schema = "seg int, part binary"
    return (df.mapInArrow(local, schema).repartition(segments, "seg")
            .mapInArrow(add, schema))


def collect_table(parts: DataFrame, shape: tuple[int, ...], segments: int = 32) -> np.ndarray:
    """The finished table of ``summed_tables`` (its size is fixed by ``shape``)."""
    import zlib
    out = np.zeros(int(np.prod(shape)), np.int64)
    cuts = np.linspace(0, len(out), segments + 1).astype(int)
    for r in parts.toLocalIterator():
        out[cuts[r.seg]:cuts[r.seg + 1]] = np.frombuffer(zlib.decompress(r.part), np.int64)
    return out.reshape(shape)


MARK_BITS = 22, 29  # least and most bits of a bitmap of marks


def marks(hashes: DataFrame):
    """A broadcast bitmap of well-spread 64-bit hashes (one long column) and its
    number of bits: 16 to 32 a hash, up to 64 MB.  It only spares sending what no
    join will want; where it is full, more is sent in vain."""
    bits = int(np.clip((16 * hashes.count()).bit_length(), *MARK_BITS))
    parts, low = 64, bits - 6
    name = hashes.columns[0]

    def segment(batches: Batches) -> Batches:
        maps: dict[int, np.ndarray] = {}
        for b in batches:
            at = b.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - bits)
            part = (at >> np.uint64(low)).astype(np.int64)
            for k in np.unique(part).tolist():
                own = maps.setdefault(k, np.zeros(1 << low, bool))
                own[(at[part == k] & np.uint64((1 << low) - 1)).astype(np.int64)] = True
        for k, own in maps.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([np.packbits(own).tobytes()], pa.binary())],
                                             names=["part", "map"])

    maps = hashes.repartition(parts, F.shiftrightunsigned(name, 58)).mapInArrow(segment, "part int, map binary")
    size = 1 << (low - 3)
    table = np.zeros(parts * size, np.uint8)
    for r in maps.toLocalIterator():
        table[r.part * size:(r.part + 1) * size] = np.frombuffer(r.map, np.uint8)
    return bits, hashes.sparkSession.sparkContext.broadcast(table)


def marked(h: np.ndarray, bits: int, table: np.ndarray) -> np.ndarray:
    """Which hashes are marked (or share a bit with one that is)."""
    at = (h.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
    return (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def block_units(members: DataFrame, key: str, order: str, block: int, weight: str | None = None,
                heaviest: int = 1 << 21) -> DataFrame:
    """Spread the pairs of each bucket over units of bounded size.

    A bucket of up to ``block`` rows is one unit.  A larger one is dealt by
    hash of ``order`` into ``n = ceil(rows / block)`` blocks, and every two of
    them meet in a unit of their own: adds ``_i``, ``_j`` (the unit's blocks,
    ``_i <= _j``) and ``_mine`` (the row's own block).  Buckets of one row are
    dropped, they hold no pair.  With ``weight``, blocks are also sized to about
    ``heaviest`` of its sum.  Counting is a partial aggregation; the join
    that follows it may be split by the engine where a bucket is hot.
    """
    load = F.sum(weight) / heaviest if weight else F.lit(0.0)
    sizes = members.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), load.alias("_load")).where("_n > 1")
    n = F.ceil(F.greatest(F.col("_n") / block, "_load")).cast("int")
    out = (members.join(sizes, key).withColumn("_blocks", n)
           .withColumn("_mine", F.pmod(F.xxhash64(order), F.col("_blocks").cast("long")).cast("int")))
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    out = out.withColumn("_other", other)
    return (out.withColumn("_i", F.least("_mine", "_other"))
            .withColumn("_j", F.greatest("_mine", "_other")).drop("_other", "_n", "_load", "_blocks"))
