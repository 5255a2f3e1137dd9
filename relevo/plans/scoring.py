"""Fit a regressor on the labelled side, score the unlabelled side, clip."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clip import clip_both, clip_upper
from ..models.assemble import assemble

CLIPS = {"both": clip_both, "up": clip_upper, "none": lambda c: F.col(c).cast("double")}


def split_sides(features: DataFrame, label: str = "relevance") -> tuple[DataFrame, DataFrame]:
    """Train = rows with a label, test = rows without (the U1 union undone)."""
    return (features.where(F.col(label).isNotNull()),
            features.where(F.col(label).isNull()))


def fit_and_score(estimator, features: DataFrame, feature_cols: Sequence[str],
                  clip: str = "both", label: str = "relevance", key: str = "id"):
    """Returns ``(model, predictions(id, relevance))``.

    The estimator is anything with ``fit(df) -> model`` and
    ``model.transform(df)`` producing ``prediction`` over a ``features``
    vector column (Spark ML and this package's driver-loop models alike).
    """
    from ..sources.csvio import stage
    # one narrow table (key, label, features) feeds the fit and the scoring:
    # materialise it once instead of re-running the text plan for each side
    features = stage(features.select(key, label, *feature_cols), "features")
    train, test = split_sides(features, label)
    tr = assemble(train, feature_cols, label=label, keep=(key,))
    te = assemble(test, feature_cols, label=None, keep=(key,))
    model = estimator.fit(tr)
    pred = model.transform(te).select(F.col(key), CLIPS[clip]("prediction").alias(label))
    return model, pred
