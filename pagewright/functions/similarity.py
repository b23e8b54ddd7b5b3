"""Longest common subsequence of two strings, for the few rows that reach the final ranking."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from pagewright.functions.exprs import once


def lcs_length(a: str, b: str) -> int:
    """Bit-parallel: one big-integer addition per character of ``b``."""
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    unmatched = full
    for ch in b:
        matched = unmatched & places.get(ch, 0)
        unmatched = (unmatched + matched | unmatched - matched) & full
    return len(a) - unmatched.bit_count()


@F.pandas_udf(IntegerType())
def _lcs(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(
        [None if x is None or y is None else lcs_length(x, y) for x, y in zip(a, b)], dtype="Int32"
    )


def longest_common_subsequence(a: Column, b: Column) -> Column:
    return once(_lcs)(a, b)
