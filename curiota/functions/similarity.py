"""String similarity for names: normalized indel ratio and close matches (Arrow)."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    state = full
    for c in b:
        match = state & masks.get(c, 0)
        state = ((state + match) | (state - match)) & full
    return len(a) - state.bit_count()


def ratio(a: str, b: str) -> float:
    """Twice the common subsequence over the total length; 1 for two empty strings."""
    total = len(a) + len(b)
    return 2 * common_subsequence(a, b) / total if total else 1.0


def _ratio_series(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def similarity(a: Column, b: Column) -> Column:
    """Column form of :func:`ratio`; null if either side is."""

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return _ratio_series(x, y)

    return run(a, b)


def closest(word: str, choices: list[str], cutoff: float = 0.6) -> str | None:
    """The most similar choice above a cutoff."""
    found = difflib.get_close_matches(word, choices, n=1, cutoff=cutoff)
    return found[0] if found else None
