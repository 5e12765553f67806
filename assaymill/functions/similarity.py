"""Arrow helpers for text and vector similarity."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

PREFIX_WEIGHT = 0.1
PREFIX_LENGTH = 4
BOOST_ABOVE = 0.7


def jaro_winkler_score(a: str, b: str) -> float:
    """Jaro similarity, raised for a common prefix when it is above 0.7."""
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken = [False] * len(b)
    matched_a = []
    for i, letter in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == letter:
                taken[j] = True
                matched_a.append(letter)
                break
    matches = len(matched_a)
    if not matches:
        return 0.0
    matched_b = [letter for letter, used in zip(b, taken) if used]
    swaps = sum(x != y for x, y in zip(matched_a, matched_b)) // 2
    score = (matches / len(a) + matches / len(b) + (matches - swaps) / matches) / 3
    if score > BOOST_ABOVE:
        common = 0
        for x, y in zip(a[:PREFIX_LENGTH], b):
            if x != y:
                break
            common += 1
        score += common * PREFIX_WEIGHT * (1 - score)
    return score


@F.pandas_udf(T.DoubleType())
def _jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    known: dict[tuple[str, str], float] = {}
    scores = []
    for pair in zip(a.fillna(""), b.fillna("")):
        if pair not in known:
            known[pair] = jaro_winkler_score(*pair)
        scores.append(known[pair])
    return pd.Series(scores, dtype="float64")


def jaro_winkler(a: Column, b: Column) -> Column:
    """Jaro-Winkler similarity to nine places."""
    return F.round(_jaro_winkler(a, b), 9)


@F.pandas_udf(T.DoubleType())
def sparse_dot(ids_a: pd.Series, weights_a: pd.Series, ids_b: pd.Series, weights_b: pd.Series) -> pd.Series:
    """Dot product of sparse vectors given as arrays of distinct ids and weights."""
    dots = np.zeros(len(ids_a))
    for row, (ia, wa, ib, wb) in enumerate(zip(ids_a, weights_a, ids_b, weights_b)):
        _, left, right = np.intersect1d(ia, ib, assume_unique=True, return_indices=True)
        dots[row] = np.dot(wa[left], wb[right])
    return pd.Series(dots)
