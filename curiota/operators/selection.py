"""Selection operators: each annotates rows with a nullable flag, or filters them.

With ``flag=True`` a column ``flag_<key>_<operator>[_<arguments>]`` is added;
with ``flag=False`` rows are kept by the condition, and rows where it is null
stay unless ``dropna``.  All are built-in expressions on one row, so they push
down, fuse into one stage and run on streams.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType

from curiota.functions.dates import VALID_PARTIAL, days_in_month, partial_parts
from curiota.functions.naming import col, current
from curiota.functions.nulls import is_missing, keep_or_flag
from curiota.functions.text import fold, fold_any
from curiota.operators.registry import operator


def _source(df: DataFrame, key: str) -> str:
    found = current(df.columns, key)
    if found is None:
        raise KeyError(f"no column {key}")
    return found


def _listed(values) -> list:
    return list(values) if isinstance(values, list | tuple | set) else [values]


def flag_suffix(values: list, minimize: bool = False, mapping: dict | None = None) -> str:
    """Arguments as they stand in a flag's name, or their numbers under a mapping.

    Without a mapping values are numbered in the order given.
    """
    if not minimize:
        return "-".join(str(v) for v in values)
    mapping = mapping or {v: i for i, v in enumerate(values)}
    return "-".join(str(mapping[v]) for v in values)


def aligned(df: DataFrame, key: str, values: Sequence) -> list[Column]:
    """Literals in the type of the column; texts of a Boolean are read case-insensitively."""
    kind = df.schema[key].dataType
    if isinstance(kind, BooleanType):
        return [F.lit(v if isinstance(v, bool) else str(v).lower() == "true") for v in values]
    if isinstance(kind, StringType):
        return [F.lit(str(v)) for v in values]
    return [F.lit(v).try_cast(kind) for v in values]


def _pattern(values: list) -> str:
    return "|".join(f"(?:{v})" for v in values)


@operator("selection")
def contains(df: DataFrame, key: str, values, flag: bool = False, minimize_flagname: bool = False, flagname_mapping: dict | None = None, dropna: bool = False) -> DataFrame:
    """Rows whose text has a match of any of the regular expressions."""
    k, v = _source(df, key), _listed(values)
    name = f"flag_{k}_contains_{flag_suffix(v, minimize_flagname, flagname_mapping)}"
    return keep_or_flag(df, col(k).cast("string").rlike(_pattern(v)), name, flag, dropna)


@operator("selection")
def doesnotcontain(df: DataFrame, key: str, values, flag: bool = False, minimize_flagname: bool = False, flagname_mapping: dict | None = None, dropna: bool = False) -> DataFrame:
    """Rows whose text has no match of any of the regular expressions."""
    k, v = _source(df, key), _listed(values)
    name = f"flag_{k}_doesnotcontain_{flag_suffix(v, minimize_flagname, flagname_mapping)}"
    return keep_or_flag(df, ~col(k).cast("string").rlike(_pattern(v)), name, flag, dropna)


@operator("selection")
def isin(df: DataFrame, key: str, values, flag: bool = False, minimize_flagname: bool = False, flagname_mapping: dict | None = None, dropna: bool = False) -> DataFrame:
    """Rows whose value is one of ``values``, compared in the column's type."""
    k, v = _source(df, key), _listed(values)
    name = f"flag_{k}_isin_{flag_suffix(v, minimize_flagname, flagname_mapping)}"
    return keep_or_flag(df, col(k).isin(*aligned(df, k, v)), name, flag, dropna)


@operator("selection")
def notisin(df: DataFrame, key: str, values, flag: bool = False, minimize_flagname: bool = False, flagname_mapping: dict | None = None, dropna: bool = False) -> DataFrame:
    """Rows whose value is none of ``values``."""
    k, v = _source(df, key), _listed(values)
    name = f"flag_{k}_notisin_{flag_suffix(v, minimize_flagname, flagname_mapping)}"
    return keep_or_flag(df, ~col(k).isin(*aligned(df, k, v)), name, flag, dropna)


@operator("selection")
def isna(df: DataFrame, key: str, stdnan: bool = True, nan_values=None, stdnan_additional_policy: str = "", flag: bool = False) -> DataFrame:
    """Flags missing values, or drops their rows; the flag is never null."""
    k = _source(df, key)
    missing = is_missing(col(k), nan_values, stdnan_additional_policy) if stdnan else col(k).isNull()
    return keep_or_flag(df, missing, f"flag_{k}_isna", flag, True, keep_when=False)


#: How bounds are written in flag names.
BOUNDS = {">": "SUP", ">=": "SUPEQ", "<": "INF", "<=": "INFEQ"}


@operator("selection")
def isboundedby(df: DataFrame, key: str, operator: str, value: float, flag: bool = False, dropna: bool = False) -> DataFrame:
    """Rows whose number satisfies the comparison (they are kept)."""
    if operator not in BOUNDS:
        raise ValueError(f"operator must be one of {sorted(BOUNDS)}")
    k = _source(df, key)
    number = numeric(df, k)
    test = {">": number > value, ">=": number >= value, "<": number < value, "<=": number <= value}[operator]
    sign = "NEG" if value < 0 else "POS"
    return keep_or_flag(df, test, f"flag_{k}_isboundedby_{BOUNDS[operator]}-{sign}{abs(value)}", flag, dropna)


def numeric(df: DataFrame, key: str) -> Column:
    """A column as a number: NaN and unreadable text are null."""
    if isinstance(df.schema[key].dataType, NumericType) and df.schema[key].dataType.typeName() not in ("double", "float"):
        return col(key)
    value = col(key).try_cast("double")
    return F.when(~F.isnan(value), value)


@operator("selection", keyed=False)
def dropvalues(df: DataFrame, dropna: bool = False, **columns) -> DataFrame:
    """Drops rows where any named column has one of the given values."""
    hit = F.lit(False)
    for key, values in columns.items():
        k = _source(df, key)
        hit = hit | F.coalesce(col(k).isin(*aligned(df, k, _listed(values))), F.lit(dropna))
    return df.where(~hit)


@operator("selection")
def iszero(df: DataFrame, key: str, flag: bool = False, eps: float = 1e-5, dropna: bool = False) -> DataFrame:
    k = _source(df, key)
    return keep_or_flag(df, F.abs(numeric(df, k)) <= eps, f"flag_{k}_iszero", flag, dropna, keep_when=False)


@operator("selection", keyed=False)
def islatlonzero(df: DataFrame, latkey: str, lonkey: str, flag: bool = False, dropna: bool = True, eps: float = 1e-5) -> DataFrame:
    """Latitude or longitude is zero; true wins over null."""
    a, b = _source(df, latkey), _source(df, lonkey)
    zero = (F.abs(numeric(df, a)) <= eps) | (F.abs(numeric(df, b)) <= eps)
    return keep_or_flag(df, zero, f"flag_{a}_{b}_islatlonzero", flag, dropna, keep_when=False)


@operator("selection", keyed=False)
def doeslateqlon(df: DataFrame, latkey: str, lonkey: str, flag: bool = False, eps: float = 1e-5, dropna: bool = False) -> DataFrame:
    a, b = _source(df, latkey), _source(df, lonkey)
    same = F.abs(numeric(df, a) - numeric(df, b)) <= eps
    return keep_or_flag(df, same, f"flag_{a}_{b}_doeslateqlon", flag, dropna, keep_when=False)


@operator("selection", keyed=False)
def islatloninvalid(df: DataFrame, latkey: str, lonkey: str, flag: bool = False, dropna: bool = True) -> DataFrame:
    """Outside ±90 or ±180; a missing coordinate is invalid under ``dropna``, valid otherwise; never null."""
    a, b = _source(df, latkey), _source(df, lonkey)
    within = lambda c, m: F.coalesce(c.between(-m, m), F.lit(not dropna))
    bad = ~(within(numeric(df, a), 90) & within(numeric(df, b), 180))
    return keep_or_flag(df, bad, f"flag_{a}_{b}_islatloninvalid", flag, dropna, keep_when=False)


def decimals(df: DataFrame, key: str) -> Column:
    """Characters after the point in the written form; none without a point.

    Numbers are written without an exponent, with at least one digit after the point.
    """
    kind = df.schema[key].dataType
    if isinstance(kind, NumericType):
        if kind.typeName() in ("double", "float"):
            text = F.regexp_replace(col(key).cast("decimal(38,18)").cast("string"), r"0+$", "")
            text = F.when(text.endswith("."), F.concat(text, F.lit("0"))).otherwise(text)
        else:
            text = col(key).cast("string")
    else:
        text = F.trim(col(key).cast("string"))
    return F.when(text.isNotNull(), F.coalesce(F.length(F.get(F.split(text, r"\."), F.lit(1))), F.lit(0)).cast("long"))


@operator("selection")
def belowminfloatprecision(df: DataFrame, key: str, value: int, flag: bool = False, dropna: bool = False) -> DataFrame:
    """Fewer decimals than ``value``; the number of decimals comes along when flagging."""
    k = _source(df, key)
    n = decimals(df, k)
    extra = {f"{k}_floatprecision_generatedby_belowminfloatprecision": n}
    return keep_or_flag(df, n < value, f"flag_{k}_belowminfloatprecision_{value}", flag, dropna, keep_when=False, extra=extra)


@operator("selection", keyed=False)
def belowminlatlonprecision(df: DataFrame, latkey: str, lonkey: str, value: int, flag: bool = False, dropna: bool = False) -> DataFrame:
    """Both coordinates have fewer decimals than ``value``; null if either is missing."""
    a, b = _source(df, latkey), _source(df, lonkey)
    x, y = decimals(df, a), decimals(df, b)
    both = x.isNotNull() & y.isNotNull()
    extra = {f"{a}_{b}_floatprecision_generatedby_belowminlatlonprecision": F.when(both, F.greatest(x, y))}
    below = F.when(both, (x < value) & (y < value))
    return keep_or_flag(df, below, f"flag_{a}_{b}_belowminlatlonprecision_{value}", flag, dropna, keep_when=False, extra=extra)


@operator("selection")
def lettersonly(df: DataFrame, key: str, flag: bool = False, dropna: bool = False, any_script: bool = False) -> DataFrame:
    """Nothing but letters, white space and dashes once folded to ASCII.

    ``any_script`` also folds scripts other than Latin, in an Arrow function.
    """
    k = _source(df, key)
    folded = fold_any(col(k)) if any_script else fold(col(k))
    return keep_or_flag(df, ~folded.rlike(r"[^a-zA-Z\s\-]"), f"flag_{k}_lettersonly", flag, dropna)


@operator("selection", keyed=False)
def basisofrecordisin(df: DataFrame, key: str | None = None, values=None, dropna: bool = False, std: bool = False, std_additional_values: dict | None = None, std_inplace: bool = False, flag: bool = True) -> DataFrame:
    """``isin`` on the record basis, standardized before if asked; the shortest column of that name is found by itself."""
    from curiota.operators.transforms import mapbasisofrecord

    if key is None:
        named = sorted((c for c in df.columns if "basisOfRecord" in c and not c.startswith("flag_")), key=lambda c: (len(c), c))
        if not named:
            raise KeyError("no column with basisOfRecord in its name")
        key = named[0]
    if std:
        df = mapbasisofrecord(df, key, additional_values=std_additional_values, inplace=std_inplace)
    return isin(df, key, values, flag=flag, dropna=dropna)


@operator("selection", keyed=False)
def isdateinvalid(df: DataFrame, datekey: str | None = None, yearkey: str | None = None, monthkey: str | None = None, daykey: str | None = None, flag: bool = False, dropna: bool = False) -> DataFrame:
    """Not a calendar date ``YYYY[-MM[-DD]]`` or year, month, day without gaps; never null: missing counts as ``dropna``."""
    if datekey is not None:
        k = _source(df, datekey)
        text = col(k).cast("string")
        year, month, day = partial_parts(text)
        formed, name = text.rlike(VALID_PARTIAL), f"flag_{k}_isdateinvalid"
        missing = text.isNull()
    else:
        keys = [_source(df, x) for x in (yearkey, monthkey, daykey) if x is not None]
        parts = [col(x).try_cast("double").cast("int") for x in keys] + [F.lit(None).cast("int")] * (3 - len(keys))
        year, month, day = parts
        gap = (year.isNull() & (month.isNotNull() | day.isNotNull())) | (month.isNull() & day.isNotNull())
        unread = F.lit(False)
        for x, part in zip(keys, parts, strict=False):
            unread = unread | (col(x).isNotNull() & part.isNull())
        formed, name = ~gap & ~unread, f"flag_{'_'.join(keys)}_isdateinvalid"
        missing = year.isNull() & month.isNull() & day.isNull()
    wrong = F.coalesce(month > 12, F.lit(False)) | F.coalesce(day > F.coalesce(days_in_month(year, month), F.lit(0)), F.lit(False))
    bad = F.when(missing, F.lit(dropna)).otherwise(~F.coalesce(formed, F.lit(False)) | wrong)
    return keep_or_flag(df, bad, name, flag, dropna, keep_when=False)


@operator("selection", keyed=False)
def isdateunlikely(df: DataFrame, datekey: str | None = None, yearkey: str | None = None, year_min: int = 1700, year_max: int | None = None, flag: bool = False, dropna: bool = False) -> DataFrame:
    """Year outside [year_min, year_max]; a text without four leading digits is an error."""
    year_max = date.today().year if year_max is None else year_max
    k = _source(df, datekey if datekey is not None else yearkey)
    text = F.regexp_replace(col(k).cast("string"), r"\.0+$", "")
    shape = r"^\d{4}(-|$)" if datekey is not None else r"^\d{1,4}$"
    year = F.when(text.rlike(shape), F.regexp_extract(text, r"^(\d+)", 1).cast("int")).otherwise(
        F.when(text.isNotNull(), F.raise_error(F.concat(F.lit(f"isdateunlikely: malformed {k}: "), text)).cast("int"))
    )
    return keep_or_flag(df, ~year.between(year_min, year_max), f"flag_{k}_isdateunlikely_{year_min}-{year_max}", flag, dropna, keep_when=False)


def isdateinterval(c: Column) -> Column:
    """Whether a date text is an interval; false for null."""
    return F.coalesce(F.instr(c, "/") > 0, F.lit(False))


def escaped(values: Sequence[str]) -> list[str]:
    """Literal texts as regular expressions, for :func:`contains`."""
    return [re.sub(r"([\\.\[\]{}()*+?^$|])", r"\\\1", v) for v in values]
