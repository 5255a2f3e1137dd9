"""relevo: search-relevance features and regression models as Spark DataFrame plans.

Layout
  sources/    table scans with declared schemas, CSV in/out, staging
  functions/  column expressions for text (overlap, tokens, clipping) and the
              two Arrow helpers (edit-similarity ratio, Snowball stems)
  operators/  relational building blocks: joins, attribute aggregation,
              TF-IDF tables, word vectors, k-NN join, ordering, metrics
  models/     regressors (Spark ML where it exists, driver loops otherwise)
  plans/      the feature sets and scoring flows assembled from the above
"""

__all__ = ["session"]

import sys as _sys

# Ship this package's UDF code with each task (pickled by value), so
# executors need no installed copy of the package.
try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle without the hook
    pass
