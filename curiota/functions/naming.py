"""Column provenance: which column an operator reads and what its result is called.

A column that was processed before carries ``_processedby_<op>[_<op>...]``, a
new one ``_generatedby_<op>``.  Plans keep using base names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROCESSED, GENERATED = "_processedby_", "_generatedby_"


class NameConflict(ValueError):
    """Several processed forms of one base name, or an operator applied twice."""


@dataclass(frozen=True)
class Resolved:
    source: str | None
    target: str
    renames: dict[str, str] = field(default_factory=dict)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """A column by its literal name (dots, dashes and regex text included)."""
    return F.col(quoted(name))


def base_name(name: str) -> str:
    return name.split(PROCESSED, 1)[0]


def current(columns: list[str], key: str, minimize: bool = True) -> str | None:
    """The newest form of ``key`` among ``columns``; None if there is none."""
    base = base_name(key)
    forms = [c for c in columns if c.startswith(base + PROCESSED)]
    if len(forms) > 1:
        longest = max(forms, key=len)
        if minimize or not all(set(c) <= set(longest) for c in forms):
            raise NameConflict(f"several processed forms of {base}: {forms}")
        return longest
    if forms:
        return forms[0]
    return base if base in columns else None


def resolve(columns: list[str], key: str, module: str, inplace: bool, minimize: bool = True) -> Resolved:
    """Input column, output column and the rename an in-place operator makes."""
    source = current(columns, key, minimize)
    if source is None:
        return Resolved(None, base_name(key) + GENERATED + module)
    if PROCESSED in source:
        if module in source.split(PROCESSED, 1)[1].split("_"):
            raise NameConflict(f"{module} was applied to {source} before")
        target = f"{source}_{module}"
        inplace = inplace or minimize
    else:
        target = source + PROCESSED + module
    return Resolved(source, target, {source: target} if inplace else {})


def put(df: DataFrame, where: Resolved, value: Column) -> DataFrame:
    """Write a result where :func:`resolve` says: in place at its position, or as a new column."""
    if where.source in where.renames:
        return df.select(*(value.alias(where.target) if c == where.source else col(c) for c in df.columns))
    return df.withColumn(where.target, value)
