"""edit-similarity ratio, ``2 * LCS(a, b) / (len(a) + len(b))``.

This is the indel ratio (insert/delete cost 1, substitution cost 2); both
empty gives 1.0.  Spark's ``levenshtein`` counts a substitution as 1, so it
cannot be used.  No built-in expression computes an LCS, so this is one of
the two Arrow helpers: a vectorised pandas UDF that runs the bit-parallel
LCS recurrence (Allison-Dix / Hyyrö) with the *longer* string as the bit
vector, i.e. ``len(shorter)`` big-integer steps per row, each over
``len(longer)`` bits.  Whole texts are used, never prefixes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence (code points)."""
    if len(a) < len(b):
        a, b = b, a          # a: longer (bit vector), b: shorter (steps)
    m = len(a)
    if m == 0 or not b:
        return 0
    codes = np.frombuffer(a.encode("utf-32-le"), dtype=np.uint32)
    masks = {}
    for ch in set(b):
        bits = np.packbits(codes == ord(ch), bitorder="little")
        masks[ch] = int.from_bytes(bits.tobytes(), "little")
    full = (1 << m) - 1
    v = full
    for ch in b:
        pm = masks[ch]
        if pm:
            u = v & pm
            v = ((v + u) | (v & ~pm)) & full
    return m - v.bit_count()


def ratio(a: str | None, b: str | None) -> float | None:
    if a is None or b is None:
        return None
    total = len(a) + len(b)
    if total == 0:
        return 1.0
    return 2.0 * lcs_length(a, b) / total


@F.pandas_udf(T.DoubleType())
def _edit_ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([ratio(x, y) for x, y in zip(a, b)], dtype="float64")


def edit_ratio(a, b) -> Column:
    """Column of the edit-similarity ratio of two string columns (null if either is null)."""
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    return _edit_ratio_udf(ca, cb)
