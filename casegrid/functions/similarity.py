"""String similarity scorers used on candidate pairs only.

Pure Python (no third-party fuzzy library is available). Both run inside
Arrow-batched pandas UDFs over de-duplicated candidate pairs produced by the
blocking joins in ``operators.resolve``.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence length (bit-parallel, Python ints as bit sets)."""
    if not a or not b:
        return 0
    if len(a) < len(b):
        a, b = b, a
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        u = v & masks.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - bin(v).count("1")


def _norm_sim(dist: int, lensum: int) -> float:
    return 100.0 if lensum == 0 else 100.0 * (1.0 - dist / lensum)


def indel_distance(a: str, b: str) -> int:
    return len(a) + len(b) - 2 * lcs_length(a, b)


def token_set_ratio(s1: str, s2: str) -> float:
    """Token-set similarity 0..100 on whitespace tokens, no case folding."""
    if s1 is None or s2 is None:
        return 0.0
    ta, tb = set(s1.split()), set(s2.split())
    if not ta or not tb:
        return 0.0
    inter = ta & tb
    diff_ab, diff_ba = ta - tb, tb - ta
    if inter and (not diff_ab or not diff_ba):
        return 100.0
    ab = " ".join(sorted(diff_ab))
    ba = " ".join(sorted(diff_ba))
    sect_len = len(" ".join(sorted(inter)))
    sep = 1 if sect_len else 0
    sect_ab_len = sect_len + sep + len(ab)
    sect_ba_len = sect_len + sep + len(ba)
    result = _norm_sim(indel_distance(ab, ba), sect_ab_len + sect_ba_len)
    if not sect_len:
        return result
    r_ab = _norm_sim(sep + len(ab), sect_len + sect_ab_len)
    r_ba = _norm_sim(sep + len(ba), sect_len + sect_ba_len)
    return max(result, r_ab, r_ba)


def jaro(s1: str, s2: str) -> float:
    if s1 == s2:
        return 1.0
    l1, l2 = len(s1), len(s2)
    if l1 == 0 or l2 == 0:
        return 0.0
    window = max(max(l1, l2) // 2 - 1, 0)
    m1 = [False] * l1
    m2 = [False] * l2
    matches = 0
    for i, ch in enumerate(s1):
        lo, hi = max(0, i - window), min(l2, i + window + 1)
        for j in range(lo, hi):
            if not m2[j] and s2[j] == ch:
                m1[i] = m2[j] = True
                matches += 1
                break
    if matches == 0:
        return 0.0
    k = trans = 0
    for i in range(l1):
        if m1[i]:
            while not m2[k]:
                k += 1
            if s1[i] != s2[k]:
                trans += 1
            k += 1
    t = trans // 2  # integer half, as in the common C implementations
    return (matches / l1 + matches / l2 + (matches - t) / matches) / 3.0


def jaro_winkler(s1: str, s2: str, prefix_weight: float = 0.1) -> float:
    """Jaro-Winkler: common prefix (max 4) boost applied when Jaro > 0.7."""
    if s1 is None or s2 is None:
        return 0.0
    j = jaro(s1, s2)
    if j <= 0.7:
        return j
    prefix = 0
    for a, b in zip(s1[:4], s2[:4]):
        if a != b:
            break
        prefix += 1
    return j + prefix * prefix_weight * (1.0 - j)


@F.pandas_udf(T.DoubleType())
def _token_set_ratios(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_set_ratio(x, y) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def _jaro_winklers(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([jaro_winkler(x, y) for x, y in zip(a, b)], dtype="float64")


# Filters on a score must not make Spark compute it twice.
token_set_ratio_udf = _token_set_ratios.asNondeterministic()
jaro_winkler_udf = _jaro_winklers.asNondeterministic()
