"""Row-local transformations: categories, licences, issue codes, casts and renames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curiota.functions.naming import PROCESSED, col, current, put, resolve
from curiota.functions.nulls import stdnan as _stdnan
from curiota.operators.registry import operator

#: The target categories, and spellings of the public Darwin Core vocabulary that map to each.
BASIS = {
    "OCCURRENCE": ["OCCURRENCE", "OCCURENCE", "UNKNOWN", "NOMENCLATURALCHECKLIST", "TAXON"],
    "HUMAN_OBSERVATION": ["HUMAN_OBSERVATION", "HUMANOBSERVATION", "HUMAN OBSERVATION", "OBSERVATION", "O"],
    "MACHINE_OBSERVATION": ["MACHINE_OBSERVATION", "MACHINEOBSERVATION", "MACHINE OBSERVATION"],
    "MATERIAL_SAMPLE": ["MATERIAL_SAMPLE", "MATERIALSAMPLE", "MATERIAL SAMPLE", "MATERIAL_ENTITY", "MATERIALENTITY"],
    "MATERIAL_CITATION": ["MATERIAL_CITATION", "MATERIALCITATION", "MATERIAL CITATION", "LITERATURE"],
    "FOSSIL_SPECIMEN": ["FOSSIL_SPECIMEN", "FOSSILSPECIMEN", "FOSSIL SPECIMEN"],
    "LIVING_SPECIMEN": ["LIVING_SPECIMEN", "LIVINGSPECIMEN", "LIVING SPECIMEN"],
    "PRESERVED_SPECIMEN": ["PRESERVED_SPECIMEN", "PRESERVEDSPECIMEN", "PRESERVED SPECIMEN", "SPECIMEN", "S"],
}


@operator("transformation")
def stdnan(df: DataFrame, key: str | None = None, nan_values=None, additional_policy: str = "") -> DataFrame:
    """Null-normalize one column or all."""
    return _stdnan(df, current(df.columns, key) if key else None, nan_values, additional_policy)


def category(value: Column, spellings: dict[str, str], default: str, null_as_default: bool = True) -> Column:
    """Dictionary lookup on the upper-case value; unknown values, and null if asked, get the default."""
    pairs = [F.lit(x) for item in spellings.items() for x in item]
    found = F.coalesce(F.try_element_at(F.create_map(*pairs), F.upper(value)), F.lit(default))
    return found if null_as_default else F.when(value.isNotNull(), found)


@operator("transformation")
def mapbasisofrecord(df: DataFrame, key: str, additional_values: dict[str, str] | None = None, inplace: bool = False, null_as_default: bool = True) -> DataFrame:
    """Standardize the basis of record; extra spellings override and must map to known categories.

    The reference rule for null is a default lookup; ``null_as_default=False`` keeps null.
    """
    spellings = {s: target for target, known in BASIS.items() for s in known}
    for s, target in (additional_values or {}).items():
        if target not in BASIS:
            raise ValueError(f"{target!r} is not one of {sorted(BASIS)}")
        spellings[s.upper()] = target
    where = resolve(df.columns, key, "mapbasisofrecord", inplace)
    if where.source is None:
        raise KeyError(f"no column {key}")
    value = category(col(where.source), spellings, "OCCURRENCE", null_as_default)
    if "basis" not in where.source.lower() and "record" not in where.source.lower():
        return df.withColumn("basisOfRecord_generatedby_mapbasisofrecord", value)
    return put(df, where, value)


def append_issue(issues: Column, code: Column | str, where: Column | None = None) -> Column:
    """``;``-joined codes with one more on rows where the condition holds."""
    code = F.lit(code) if isinstance(code, str) else code
    more = F.concat_ws(";", F.when(issues != "", issues), code)
    return more if where is None else F.when(F.coalesce(where, F.lit(False)), more).otherwise(issues)


@operator("transformation", keyed=False)
def modifyissuecolumn(df: DataFrame, issuekey: str, issuemsg: str, subset: Column | str | None = None) -> DataFrame:
    """Append a code to an issue column (made if missing) on the rows of ``subset``."""
    condition = F.expr(subset) if isinstance(subset, str) else subset
    before = col(issuekey) if issuekey in df.columns else F.lit(None).cast("string")
    return df.withColumn(issuekey, append_issue(before, issuemsg, condition))


@operator("transformation")
def license_std(df: DataFrame, key_in: str, key_out: str | None = None) -> DataFrame:
    """Creative Commons licence text as a code such as ``CC-BY-NC-4.0``; other text is null.

    Elements are ordered as the licences write them, versions follow where one is named.
    """
    k = current(df.columns, key_in)
    text = F.lower(col(k))
    zero = text.rlike(r"cc[ _-]?0|publicdomain/zero|\bzero\b")
    public = text.rlike(r"public ?domain")
    full = {"by": r"\bby\b|attribution", "nc": r"\bnc\b|non[ -]?commercial", "nd": r"\bnd\b|no[ -]?deriv", "sa": r"\bsa\b|share[ -]?alike"}
    spaced = F.regexp_replace(text, r"[_/-]", " ")
    parts = [F.when(spaced.rlike(p), F.lit(code.upper())) for code, p in full.items()]
    version = F.regexp_extract(text, r"(\d\.\d)", 1)
    cc = text.rlike(r"cc|creative ?commons") & spaced.rlike(full["by"])
    code = (
        F.when(zero, F.lit("CC0-1.0"))
        .when(cc, F.concat_ws("-", F.lit("CC"), *parts, F.when(version != "", version)))
        .when(public, F.lit("PDM"))
    )
    return df.withColumn(key_out or f"{k}{PROCESSED}license_std", code)


#: Types that plans may name.
TYPES = {"int": "bigint", "float": "double", "str": "string", "bool": "boolean", "datetime": "timestamp_ntz"}


def cast_to(c: Column, kind: str) -> Column:
    """A column in a plan's type; what cannot be read is null.

    Integers go through doubles and must be integral; Booleans read only true
    and false; instants accept ISO dates with missing month or day taken as 1,
    and keep their local time.
    """
    if kind == "int":
        x = c.try_cast("double")
        return F.when(x == F.floor(x), x.try_cast("bigint"))
    if kind == "bool":
        low = F.lower(c.cast("string"))
        return F.when(low == "true", F.lit(True)).when(low == "false", F.lit(False))
    if kind == "datetime":
        local = F.regexp_replace(c.cast("string"), r"(Z|[+-]\d{2}:?\d{2})$", "")
        return local.try_cast("timestamp_ntz")
    if kind == "float":
        x = c.try_cast("double")
        return F.when(~F.isnan(x), x)
    return c.cast("string")


def select_columns(df: DataFrame, variables: dict[str, dict], generated: bool = True) -> DataFrame:
    """Final projection: ``{column: {"rename": name, "type": type}}`` in one select.

    A base name stands for its newest form; the rename replaces the base part of
    processed names and of flags.  Generated and flag columns come along.
    """
    out, taken, renames = [], set(), {}
    for key, how in variables.items():
        found = current(df.columns, key)
        if found is None:
            raise KeyError(f"no column {key}")
        target = (how or {}).get("rename") or key
        renames[key] = target
        value = cast_to(col(found), how["type"]) if (how or {}).get("type") else col(found)
        out.append(value.alias(target + found[len(key) :]))
        taken.add(found)
    for c in df.columns if generated else []:
        if c not in taken and ("_generatedby_" in c or c.startswith(("flag_", "issue_"))):
            out.append(col(c).alias(_renamed(c, renames)))
    return df.select(*out)


def _renamed(name: str, renames: dict[str, str]) -> str:
    """A flag or generated name with the longest matching base name replaced."""
    prefix = "flag_" if name.startswith("flag_") else ""
    rest = name[len(prefix) :]
    for key in sorted(renames, key=len, reverse=True):
        if rest == key or rest.startswith(key + "_"):
            return prefix + renames[key] + rest[len(key) :]
    return name
