"""Null normalization and the null policy of selection operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from curiota.functions.naming import col
from curiota.functions.text import fold

#: Texts that stand for a missing value, in any case.
MISSING = [
    "-1.#IND", "1.#QNAN", "1.#IND", "-1.#QNAN", "#N/A N/A", "#N/A", "#n/a", "N/A", "n/a", "NA", "<NA>", "#NA",
    "NULL", "null", "NaN", "-NaN", "nan", "-nan", "", "nd", "None", "Unknown", "#VALUE!",
]
POLICIES = {"": None, "contains_letters": "[a-zA-Z]", "contains_digits": "[0-9]", "contains_letters_or_digits": "[a-zA-Z0-9]"}


def is_missing(c: Column, extra: list[str] | str | None = None, policy: str = "") -> Column:
    """True for null, sentinel texts and, under a policy, texts without a required character."""
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}; known: {sorted(POLICIES)}")
    extra = [extra] if isinstance(extra, str) else list(extra or [])
    words = sorted({w.lower() for w in MISSING + extra})
    text = c.cast("string")
    found = c.isNull() | F.lower(text).isin(words)
    if POLICIES[policy]:
        found = found | ~fold(text).rlike(POLICIES[policy])
    return F.coalesce(found, F.lit(True))


def stdnan(df: DataFrame, key: str | list[str] | None = None, nan_values=None, additional_policy: str = "") -> DataFrame:
    """Missing values of the given columns (all by default) become null, in one projection."""
    keys = [key] if isinstance(key, str) else list(key or df.columns)
    out = []
    for f in df.schema.fields:
        c = col(f.name)
        if f.name in keys and isinstance(f.dataType, StringType):
            c = F.when(~is_missing(c, nan_values, additional_policy), c)
        elif f.name in keys and isinstance(f.dataType, DoubleType | FloatType):
            c = F.when(~F.isnan(c), c)
        out.append(c.alias(f.name))
    return df.select(*out)


def keep_or_flag(
    df: DataFrame, value: Column, name: str, flag: bool, dropna: bool, keep_when: bool = True, extra: dict[str, Column] | None = None
) -> DataFrame:
    """Annotate with ``value``, or keep the rows where it equals ``keep_when``.

    Rows where it is null stay unless ``dropna``.  ``extra`` columns come along when flagging.
    """
    if flag:
        return df.withColumns({name: value, **(extra or {})})
    return df.where(F.coalesce(value == F.lit(keep_when), F.lit(not dropna)))
