"""Column roles -> a ``features`` vector column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assemble(df: DataFrame, feature_cols: Sequence[str], label: str | None = "relevance",
             keep: Sequence[str] = ("id",), out: str = "features",
             handle_invalid: str = "keep") -> DataFrame:
    """``(keep..., [label], features)`` with every feature cast to double.

    ``handle_invalid='keep'`` passes NaN/null through as NaN, like numpy
    arrays in the reference; use ``'skip'`` to drop such rows.
    """
    casted = df.select(*keep, *([F.col(label).cast("double").alias(label)] if label else []),
                       *[F.col(c).cast("double").alias(c) for c in feature_cols])
    va = VectorAssembler(inputCols=list(feature_cols), outputCol=out, handleInvalid=handle_invalid)
    return va.transform(casted).select(*keep, *([label] if label else []), out)
