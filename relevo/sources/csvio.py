"""CSV sources and sinks (S1-S6) and stage checkpoints.

Reads always take a declared schema (no inference pass; a key column stays
integral even when null rows exist).  Quotes are doubled inside quoted fields
(RFC 4180, as the reference's files): Spark's default escape character is a
backslash, so ``escape='"'`` is set on both sides.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import scratch_path

LATIN1 = "ISO-8859-1"
# Rows of a learner's task: fewer cost more to schedule than to read.
TASK_ROWS = 4096
_CSV_OPTS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str,
             encoding: str = LATIN1) -> DataFrame:
    """S1 (Latin-1) / S2 (``encoding='UTF-8'``): header, quoted multi-line text."""
    return spark.read.options(**_CSV_OPTS, encoding=encoding).schema(schema).csv(path)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """``spark.read.csv(path, header=True, inferSchema=True)`` (an extra pass)."""
    return spark.read.options(**_CSV_OPTS, inferSchema="true").csv(path)


def read_side_table(spark: SparkSession, path: str, schema: T.StructType | str,
                    encoding: str = LATIN1) -> DataFrame:
    """S3: read a side table and drop rows with any null."""
    return read_csv(spark, path, schema, encoding).na.drop("any")


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8") -> str:
    """CSV with a header, no row number; a directory of part files."""
    df.write.mode("overwrite").options(**_CSV_OPTS, encoding=encoding).csv(path)
    return path


def write_csv_indexed(df: DataFrame, path: str, order: Sequence[str],
                      index_col: str = "_c0", encoding: str = "UTF-8") -> str:
    """CSV whose first column is the 0-based row number in ``order`` order."""
    from ..operators.order import row_index

    idx = row_index(df, order, index_col)
    return write_csv(idx.select(index_col, *df.columns), path, encoding)


def write_predictions(pred: DataFrame, path: str) -> str:
    """The ``(id, relevance)`` prediction file."""
    return write_csv(pred.select("id", "relevance"), path)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise an intermediate result in the shared checkpoint folder
    and continue from it: the plan runs once, types survive, lineage is cut,
    and a lost executor re-reads the files instead of recomputing the plan."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def by_key(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows by hash of ``keys`` into ``spark.sql.shuffle.partitions``
    partitions, each in key order: a step with an Arrow UDF gets as many tasks
    as any shuffle, whatever the bytes."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys).sortWithinPartitions(*keys)


@contextmanager
def merged_by_bytes(spark: SparkSession):
    """AQE joins small shuffle partitions up to its advisory size, however many
    cores there are (``parallelismFirst`` would keep one a core)."""
    key = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def staged_by_key(df: DataFrame, *keys: str, rows: int | None = TASK_ROWS) -> DataFrame:
    """Rows dealt by hash of ``keys``, each partition in key order, staged.

    Learners that draw rows by place (forests, boosting) then read the same
    files on any number of cores.  There is a file for every ``rows`` rows, at
    most ``spark.sql.shuffle.partitions`` of them: an iterative learner pays one
    task a step on a small table and has work for all cores on a larger one.
    The rows are counted first, which prunes their columns; ``rows=None`` merges
    partitions by their bytes instead.  All readers share the files: nothing is
    dealt or sorted again."""
    return stage_all_by_key([df], *keys, rows=rows)[0]


def stage_all_by_key(tables: Sequence[DataFrame], *keys: str, rows: int | None = TASK_ROWS,
                     parallelism: int = 8) -> list[DataFrame]:
    """``staged_by_key`` of several tables, side by side."""
    spark = tables[0].sparkSession
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(df: DataFrame) -> DataFrame:
        n = () if rows is None else (max(1, min(most, -(-df.count() // rows))),)
        return stage(df.repartition(*n, *keys).sortWithinPartitions(*keys), "by-key")

    with merged_by_bytes(spark), ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(run, tables))


def csv_roundtrip(df: DataFrame, name: str, encoding: str = "UTF-8",
                  indexed_by: Sequence[str] | None = None) -> DataFrame:
    """Write ``df`` as CSV to the scratch folder and read it back with its schema."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    if indexed_by:
        write_csv_indexed(df, path, indexed_by, encoding=encoding)
        schema = T.StructType([T.StructField("_c0", T.LongType())] + list(df.schema.fields))
    else:
        write_csv(df, path, encoding=encoding)
    return read_csv(spark, path, schema, encoding)


__all__ = ["read_csv", "read_csv_inferred", "read_side_table", "write_csv",
           "write_csv_indexed", "write_predictions", "stage", "by_key",
           "staged_by_key", "stage_all_by_key", "csv_roundtrip"]
