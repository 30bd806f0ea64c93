"""Fuzzy name evidence: Jaro-Winkler and the 1..5 name score."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def jaro_winkler_pair(a: str, b: str) -> float:
    """Jaro-Winkler similarity; the prefix bonus (0.1 a letter, four at most) applies above 0.7."""
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    taken, first = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                first.append(c)
                break
    if not first:
        return 0.0
    second = [c for c, t in zip(b, taken, strict=True) if t]
    swapped = sum(x != y for x, y in zip(first, second, strict=True)) // 2
    m = len(first)
    jaro = (m / len(a) + m / len(b) + (m - swapped) / m) / 3
    if jaro <= 0.7:
        return jaro
    prefix = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        prefix += 1
    return jaro + 0.1 * prefix * (1 - jaro)


@F.pandas_udf(DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    """Arrow batches, each pair of texts once; evaluate it on rows that equi joins and cheaper rules have left."""
    known = {(x, y): None if x is None or y is None else jaro_winkler_pair(x, y) for x, y in set(zip(a, b, strict=True))}
    return pd.Series([known[pair] for pair in zip(a, b, strict=True)], dtype="float64")


#: Endings that tell genders apart, and words that don't count as shared.
GUARDS = [("o", "a"), ("a", "o"), ("o", "e"), ("e", "o"), ("an", "ne"), ("ne", "an"), ("dre", "dra"), ("dra", "dre")]
WEAK_GUARDS = GUARDS[:4]
PREPOSITIONS = ["de", "da", "do", "dos", "das", "e", "a", "o"]


def _genders_differ(p: Column, c: Column, guards: list[tuple[str, str]]) -> Column:
    out = F.lit(False)
    for x, y in guards:
        out = out | (p.endswith(x) & c.endswith(y))
    return out


def name_score(p: Column, c: Column, p_fold: Column, c_fold: Column, couple: Column | None = None) -> Column:
    """1 (equal, or nothing to compare) to 5 (rejected).

    p, c: word arrays of the source and the candidate; p_fold, c_fold: phonetic
    folds of their first words; couple: whether the full names are similar
    enough for the couple rule (compute it with jaro_winkler beforehand).
    """
    first, last = F.get(p, F.lit(0)), F.try_element_at(p, F.lit(-1))
    last_in = F.coalesce(F.array_contains(c, last), F.lit(False))
    distance = F.levenshtein(p_fold, c_fold)
    added = (c_fold == F.concat(p_fold, F.lit("a"))) | (p_fold == F.concat(c_fold, F.lit("a")))
    near = (distance <= 1) & ~(_genders_differ(p_fold, c_fold, GUARDS) | added)
    spelled = (distance == 2) & last_in & ~_genders_differ(p_fold, c_fold, WEAK_GUARDS)
    evidence = F.array_contains(c, first) | F.coalesce(near, F.lit(False)) | F.coalesce(spelled, F.lit(False))
    shared = F.filter(p, lambda w: F.array_contains(c, w))
    if couple is not None:
        strong = F.size(F.filter(shared, lambda w: ~w.isin(PREPOSITIONS))) >= 2
        evidence = evidence | (F.coalesce(couple, F.lit(False)) & strong)
    return (
        F.when(p.isNull() | (F.size(p) == 0), 1)
        .when(c.isNull() | (F.size(c) == 0), 5)
        .when(p == c, 1)
        .when(~evidence, 5)
        .when(last_in, 2)
        .when(F.size(shared) > 1, 3)
        .otherwise(4)
    )


def exact_name_score(p: Column, c: Column) -> Column:
    """The earlier scorer: first-name evidence is exact membership only."""
    return name_score(p, c, F.lit(None).cast("string"), F.lit(None).cast("string"))


def any_word_name_score(p: Column, c: Column) -> Column:
    """The scorer between the two: the first name within one edit of any word."""
    first, last = F.get(p, F.lit(0)), F.try_element_at(p, F.lit(-1))
    close = F.exists(c, lambda w: F.levenshtein(w, first) <= 1)
    shared = F.size(F.filter(p, lambda w: F.array_contains(c, w)))
    return (
        F.when(p.isNull() | (F.size(p) == 0), 1).when(c.isNull() | (F.size(c) == 0), 5).when(p == c, 1).when(~close, 5)
        .when(F.array_contains(c, last), 2).when(shared > 1, 3).otherwise(4)
    )
