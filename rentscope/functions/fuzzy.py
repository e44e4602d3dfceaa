"""Similarity scoring as native higher-order expressions.

``token_sort_ratio(a, b) = 100 * 2 * LCS(ta, tb) / (len ta + len tb)`` where
``t*`` is the token-sorted text.  LCS is the classic dynamic programme,
written with nested ``aggregate`` so it runs inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import token_sort


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two strings.

    Row ``i`` of the DP table is built left to right by the inner aggregate;
    characters are read with ``substr`` so nothing is re-split per cell."""
    la, lb = F.length(a), F.length(b)
    one = F.lit(1)

    def row(prev, i):
        ai = F.substr(a, i, one)

        def cell(cur, j):
            v = F.when(ai == F.substr(b, j, one), F.element_at(prev, j) + 1) \
                 .otherwise(F.greatest(F.element_at(prev, j + 1), F.element_at(cur, j)))
            return F.concat(cur, F.array(v))
        return F.aggregate(F.sequence(one, lb), F.array(F.lit(0)), cell)

    full = F.aggregate(F.sequence(one, la), F.array_repeat(F.lit(0), lb + 1), row)
    return F.when((la == 0) | (lb == 0), F.lit(0)).otherwise(F.element_at(full, -1))


def ratio(a: Column, b: Column) -> Column:
    """Normalized indel similarity in [0, 100]; two empty strings score 100."""
    total = F.length(a) + F.length(b)
    return F.when(total == 0, F.lit(100.0)).otherwise(
        F.lit(200.0) * lcs_length(a, b) / total)


def token_sort_ratio(a: Column, b: Column) -> Column:
    return ratio(token_sort(a), token_sort(b))


def length_bound(la: Column, lb: Column) -> Column:
    """Best score any pair of these lengths can reach (LCS <= min length)."""
    total = la + lb
    return F.when(total == 0, F.lit(100.0)).otherwise(
        F.lit(200.0) * F.least(la, lb) / total)


def lcs_bitparallel(a: str, b: str) -> int:
    """LCS length by the bit-vector recurrence (one machine word per |a| bits):
    V starts all ones; per character c of b, U = V & match(c) and
    V = (V + U) | (V - U); the zero bits of V count the LCS."""
    if not a or not b:
        return 0
    match: dict[str, int] = {}
    for i, ch in enumerate(a):
        match[ch] = match.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        u = v & match.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - bin(v).count("1")


def ratio_py(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 100.0 if total == 0 else 200.0 * lcs_bitparallel(a, b) / total


def _ratio_batch(a, b):
    import pandas as pd
    return pd.Series([None if x is None or y is None else ratio_py(x, y) for x, y in zip(a, b)],
                     dtype="float64")


def ratio_vectorized(a: Column, b: Column) -> Column:
    """Same score as ``ratio``, computed per Arrow batch in Python (a small
    helper: one bit-parallel loop per pair, no per-row serialization)."""
    udf = F.pandas_udf(_ratio_batch, "double")
    return udf(a, b)
