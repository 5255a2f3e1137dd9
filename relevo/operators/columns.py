"""Keep or drop listed columns.

Spark's ``drop`` ignores unknown names; the reference's table library
raises.  ``strict=True`` raises too, so a misspelt column is not silently
kept in a feature matrix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def keep_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df[[a, b]]``."""
    return df.select(*cols)


def drop_columns(df: DataFrame, cols: Sequence[str], strict: bool = True) -> DataFrame:
    """``df.drop([...], axis=1)``."""
    if strict:
        missing = [c for c in cols if c not in df.columns]
        if missing:
            raise KeyError(f"columns not found: {missing}")
    return df.drop(*cols)
