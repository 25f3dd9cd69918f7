"""String distances that Spark SQL lacks, as Arrow batch functions.

Both are called only on candidate pairs that a blocked join has already
narrowed down with the native ``levenshtein``.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F, types as T

# The two functions travel to the workers with the query, so the package need
# not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def osa(a: str, b: str) -> int:
    """Optimal string alignment distance (adjacent transpositions cost one)."""
    before, last = [], list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        row = [i]
        for j, cb in enumerate(b, 1):
            best = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (ca != cb))
            if i > 1 and j > 1 and ca == b[j - 2] and a[i - 2] == cb:
                best = min(best, before[j - 2] + 1)
            row.append(best)
        before, last = last, row
    return last[-1]


def jaro_winkler(a: str, b: str, scale: float = 0.1) -> float:
    """Jaro similarity raised by a shared prefix of up to four characters."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used = [False] * len(b)
    hits_a = []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == ch:
                used[j] = True
                hits_a.append(ch)
                break
    m = len(hits_a)
    if m == 0:
        return 0.0
    hits_b = [ch for ch, hit in zip(b, used) if hit]
    swaps = sum(x != y for x, y in zip(hits_a, hits_b)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * scale * (1 - jaro)


@F.pandas_udf(T.IntegerType())
def osa_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([osa(x, y) for x, y in zip(a, b)])


@F.pandas_udf(T.DoubleType())
def jaro_winkler_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([jaro_winkler(x, y) for x, y in zip(a, b)])


@F.pandas_udf(T.DoubleType())
def jaro_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([jaro_winkler(x, y, 0.0) for x, y in zip(a, b)])


def levenshtein_similarity(a, b):
    """One minus the edit distance over the longer length."""
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b))
