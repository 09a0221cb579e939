"""Temporal curation: parse, convert, collapse intervals, split and reconcile dates.

Issue codes start with the upper-case base name of the column they concern.
Issue, flag and width columns are always present, whatever the data.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curiota.functions.dates import MONTHS, VALID_INTERVAL, completed, days_in_month, joined, let, month_number, partial_parts
from curiota.functions.naming import base_name, col, current, put, resolve
from curiota.functions.nulls import is_missing
from curiota.functions.text import fold, fold_text
from curiota.operators.registry import operator


def _code(key: str) -> str:
    return base_name(key).upper()


def _codes(*codes: Column) -> Column:
    """``;``-joined codes that are not null; null without any."""
    text = F.concat_ws(";", *codes)
    return F.when(text != "", text)


def _need(df: DataFrame, key: str | None) -> str | None:
    if key is None:
        return None
    found = current(df.columns, key)
    if found is None:
        raise KeyError(f"no column {key}")
    return found


def whole_number(c: Column) -> tuple[Column, Column]:
    """(value, invalid): digits with at most zero decimals as an integer, anything else null and invalid."""
    text = F.trim(c.cast("string"))
    good = text.rlike(r"^\d+(\.0*)?$")
    return F.when(good, F.regexp_extract(text, r"^(\d+)", 1).try_cast("bigint")), text.isNotNull() & ~good


def year_number(c: Column, drop_ambiguous: bool = False) -> tuple[Column, Column, Column]:
    """(value, invalid, ambiguous): three or more than four digits and zero are invalid, one or two ambiguous."""
    n, bad = whole_number(c)
    width = F.length(n.cast("string"))
    wrong = n.isNotNull() & ((width == 3) | (width > 4) | (n <= 0))
    short = n.isNotNull() & ~wrong & (width <= 2)
    value = F.when(~wrong & (~short if drop_ambiguous else F.lit(True)), n)
    return value, bad | wrong, short


def limited(c: Column, most: int) -> tuple[Column, Column]:
    """(value, invalid) of a month or day between 1 and ``most``."""
    n, bad = whole_number(c)
    wrong = n.isNotNull() & ~n.between(1, most)
    return F.when(~wrong, n), bad | wrong


@operator("transformation", keyed=False)
def convertdatetype(
    df: DataFrame,
    datekey: str | None = None,
    yearkey: str | None = None,
    monthkey: str | None = None,
    daykey: str | None = None,
    format: str = "ISO8601",
    drop_inconsistent: bool = False,
    drop_ambiguous: bool = False,
    drop_empty: bool = False,
) -> DataFrame:
    """Convert date to an instant and year, month, day to integers; problems go to ``issue_convertdatetype``.

    ``drop_empty`` drops the issue column if a pass over the data finds no issue.
    """
    codes, new = [], {}
    if datekey is not None:
        k = _need(df, datekey)
        text = F.regexp_replace(col(k).cast("string"), r"(Z|[+-]\d{2}:?\d{2})$", "")
        pattern = None if format == "ISO8601" else format
        value = text.try_cast("timestamp_ntz") if pattern is None else F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")
        new[k] = value
        codes.append(F.when(col(k).isNotNull() & value.isNull(), f"{_code(k)}_INVALID"))
    keys = [_need(df, x) for x in (yearkey, monthkey, daykey)]
    values: list[Column | None] = [None, None, None]
    if keys[0]:
        values[0], bad, short = year_number(col(keys[0]), drop_ambiguous)
        codes += [F.when(bad, f"{_code(keys[0])}_INVALID"), F.when(short, f"{_code(keys[0])}_AMBIGUOUS")]
    for i, most in ((1, 12), (2, 31)):
        if keys[i]:
            values[i], bad = limited(col(keys[i]), most)
            codes.append(F.when(bad, f"{_code(keys[i])}_INVALID"))
    if all(keys):
        y, m, d = values
        impossible = F.coalesce(d > days_in_month(y, m), F.lit(False))
        codes.append(F.when(impossible, "_".join(map(_code, keys)) + "_COMBINATION_INVALID"))
        values[2] = F.when(~impossible, d)
    named = [(k, v) for k, v in zip(keys, values, strict=True) if k]
    for (above, upper), (below, lower) in zip(named, named[1:], strict=False):
        gap = upper.isNull() & lower.isNotNull()
        codes.append(F.when(gap, f"{_code(above)}_{_code(below)}_INCONSISTENT"))
    if drop_inconsistent:
        kept = None
        for i, (k, v) in enumerate(named):
            kept = v if i == 0 else F.when(kept.isNotNull(), v)
            named[i] = (k, kept)
    new.update(dict(named))
    out = df.select(*(new[c].alias(c) if c in new else col(c) for c in df.columns), _codes(*codes).alias("issue_convertdatetype"))
    if drop_empty and not out.where(F.col("issue_convertdatetype").isNotNull()).limit(1).count():
        out = out.drop("issue_convertdatetype")
    return out


#: The date forms that are read, besides ISO.
_ISO = r"^(\d{4}(?:-\d{2}(?:-\d{2})?)?)(?:[t ]\d{2}:?\d{2}.*)?$"
_LOOSE = r"^(\d{4})[-/. ](\d{1,2})[-/. ](\d{1,2})(?:[t ]\d{1,2}:\d{2}.*)?$"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})$"
_DAY_FIRST = r"^(\d{1,2})[-/. ](\d{1,2})[-/. ](\d{4})(?:[t ]\d{1,2}:\d{2}.*)?$"
_WORDS = r"^(\d{1,2})(?:st|nd|rd|th|er|\.)?[-/. ]*(?:de )?([a-z]{3,})\.?[-/. ]*(?:de )?(\d{4})$"
_WORD_FIRST = r"^([a-z]{3,})\.?[-/. ]+(\d{1,2})(?:st|nd|rd|th)?[-/. ]+(\d{4})$"
_WORD_YEAR = r"^([a-z]{3,})\.?[-/. ]+(\d{4})$"


def iso_date(text: Column) -> Column:
    """One date (not an interval) in any accepted form as ``YYYY[-MM[-DD]]``; null for other text.

    Accepted: ISO dates with or without a time, year and month, year,
    day-month-year and month-day-year where one part exceeds 12 or the month is a
    word, and compact ``YYYYMMDD``.  Numeric dates that two orders can read are refused.
    """

    def read(low: Column) -> Column:
        part = lambda p, i: F.regexp_extract(low, p, i)
        number = lambda p, i: part(p, i).try_cast("int")
        ymd = lambda p: joined(number(p, 1), number(p, 2), number(p, 3))
        nothing = F.lit(None).cast("int")

        def ordered(x: Column) -> Column:
            a, b, year = x["a"], x["b"], x["y"]
            day_first, month_first = ((a > 12) & (b <= 12)) | (a == b), (b > 12) & (a <= 12)
            return F.when(day_first, joined(year, b, a)).when(month_first, joined(year, a, b))

        def worded(p: str, word: int, year: int, day: int | None) -> Column:
            return let(
                month_number(part(p, word)),
                lambda m: F.when(m.isNotNull(), joined(number(p, year), m, number(p, day) if day else nothing)),
            )

        return (
            F.when(low.rlike(_ISO), part(_ISO, 1))
            .when(low.rlike(_LOOSE), ymd(_LOOSE))
            .when(low.rlike(_COMPACT), ymd(_COMPACT))
            .when(low.rlike(_DAY_FIRST), let(F.struct(*(number(_DAY_FIRST, i).alias(n) for i, n in enumerate("aby", 1))), ordered))
            .when(low.rlike(_WORDS), worded(_WORDS, 2, 3, 1))
            .when(low.rlike(_WORD_FIRST), worded(_WORD_FIRST, 1, 3, 2))
            .when(low.rlike(_WORD_YEAR), worded(_WORD_YEAR, 1, 2, None))
        )

    return let(let(F.lower(fold(F.trim(text))), read), lambda iso: F.when(completed(iso).isNotNull(), iso))


def _date_or_interval(clean: Column) -> Column:
    """``YYYY[-MM[-DD]]``, or two of them in order joined by ``/``; null for other text."""

    def sides(s: Column) -> Column:
        def both(x: Column) -> Column:
            a, b = x["a"], x["b"]
            known = a.isNotNull() & b.isNotNull()
            return F.when(known, F.when(a == b, a).otherwise(F.concat_ws("/", F.least(a, b), F.greatest(a, b))))

        return F.when(F.size(s) == 2, let(F.struct(iso_date(F.get(s, F.lit(0))).alias("a"), iso_date(F.get(s, F.lit(1))).alias("b")), both))

    interval = clean.rlike(r"^\s*\d{4}[-\d]*(?:[Tt ][^/]*)?\s*/")
    return F.coalesce(F.when(interval, let(F.split(clean, "/"), sides)), iso_date(clean))


@operator("transformation", keyed=False)
def parsedate(
    df: DataFrame,
    datekey: str,
    yearkey: str | None = None,
    monthkey: str | None = None,
    daykey: str | None = None,
    inplace: bool = False,
    stdnan: bool = True,
    year_min: int = 1600,
    year_max: int = 2100,
) -> DataFrame:
    """Free text to an ISO date or ``start/end``; where there is none, rebuilt from year, month and day.

    ``issue_parsedate`` gets ``_INVALID`` for text that cannot be read (including
    numeric dates of ambiguous order), ``_UNLIKELY`` for years out of range and
    ``_ASSEMBLED`` for rebuilt dates.
    """
    where = resolve(df.columns, datekey, "parsedate", inplace)
    if where.source is None:
        raise KeyError(f"no column {datekey}")
    raw = col(where.source).cast("string")
    if stdnan:
        raw = F.when(~is_missing(raw), raw)
    code = _code(where.source)
    keys = [_need(df, x) for x in (yearkey, monthkey, daykey)]
    built = F.lit(None).cast("string")
    if keys[0]:
        nothing = F.lit(None).cast("bigint")
        y = year_number(col(keys[0]), drop_ambiguous=True)[0]
        m = limited(col(keys[1]), 12)[0] if keys[1] else nothing
        d = limited(col(keys[2]), 31)[0] if keys[2] else nothing
        possible = lambda x: F.when(x["d"] <= F.coalesce(days_in_month(x["y"], x["m"]), F.lit(0)), x["d"])
        parts = F.struct(y.alias("y"), m.alias("m"), d.alias("d"))
        df = df.withColumn("__parts", let(parts, lambda x: F.struct(x["y"].alias("y"), x["m"].alias("m"), possible(x).alias("d"))))
        y, m, d = (F.col(f"__parts.{n}") for n in "ymd")
        df = df.withColumn("__code", _mismatch(raw, y, m, d))
        built = F.when(~F.coalesce(F.col("__code").contains("MISMATCH"), F.lit(False)), joined(y, m, d))

    def finish(x: Column) -> Column:
        read, made = x["read"], x["made"]
        unlikely = F.coalesce(~F.substring(read, 1, 4).try_cast("int").between(year_min, year_max), F.lit(False))
        issue = _codes(
            F.when(x["raw"].isNotNull() & read.isNull(), f"{code}_INVALID"),
            F.when(unlikely, f"{code}_UNLIKELY"),
            F.when(read.isNull() & made.isNotNull(), f"{code}_ASSEMBLED"),
        )
        value = F.when(read.isNull(), made).when(~unlikely, read)
        return F.struct(value.alias("value"), issue.alias("issue"))

    clean = F.trim(F.regexp_replace(F.regexp_replace(raw, r"""[,;()"']+""", " "), r"\s+", " "))
    staged = F.struct(raw.alias("raw"), let(clean, _date_or_interval).alias("read"), built.alias("made"))
    out = df.withColumn("__parsed", let(staged, finish)).withColumn("issue_parsedate", F.col("__parsed.issue"))
    return put(out, where, F.col("__parsed.value")).drop("__parsed", "__parts", "__code")


def mismatch_of(text: str | None, year: int | None, month: int | None, day: int | None) -> str | None:
    """Does an unparsed date text contradict its parts?  Returns a code, or None for no contradiction.

    The year, then the month, then the day are looked for among the numbers of
    the text and used up; the first that is not found is a mismatch.
    """
    if text is None:
        return None
    low = fold_text(text).lower()
    for n, words in MONTHS.items():
        if found := next((w for w in sorted(words, key=len, reverse=True) if re.search(rf"(?<![a-z]){w}(?![a-z])", low)), None):
            low = re.sub(rf"(?<![a-z]){found}(?![a-z])", f" {n} ", low, count=1)
            break
    prefix = "UNCERTAIN_" if len(low.strip()) > 10 else ""
    numbers = re.findall(r"\d+", low)
    if len(numbers) == 1 and len(numbers[0]) == 8:
        numbers = [numbers[0][:4], numbers[0][4:6], numbers[0][6:]]
    for name, value in (("YEAR", year), ("MONTH", month), ("DAY", day)):
        if value is None or not numbers:
            continue
        wanted = {str(value), f"{value:02d}"} | ({f"{value % 100:02d}"} if name == "YEAR" else set())
        at = next((i for i, x in enumerate(numbers) if x in wanted or (name == "YEAR" and int(x) == value)), None)
        if at is None:
            return f"{prefix}DATE_{name}_MISMATCH"
        numbers.pop(at)
    left = [x for x in numbers if int(x)]
    if prefix and left and None not in (year, month, day):
        return "UNCERTAIN_DATE_YEAR_MONTH_DAY_MATCH"
    return None


def _mismatch(text: Column, year: Column, month: Column, day: Column) -> Column:
    @F.pandas_udf("string")
    def run(t: pd.Series, y: pd.Series, m: pd.Series, d: pd.Series) -> pd.Series:
        whole = lambda x: None if pd.isna(x) else int(x)
        return pd.Series([mismatch_of(a, whole(b), whole(c), whole(e)) for a, b, c, e in zip(t, y, m, d, strict=True)], dtype=object)

    return run(text, year, month, day)


@operator("transformation", keyed=False)
def isdatemismatch(
    df: DataFrame, datekey: str, yearkey: str, monthkey: str | None = None, daykey: str | None = None, stdnan: bool = True, cvttype: bool = True
) -> DataFrame:
    """``issue_isdatemismatch``: contradictions between a date text and its parts, with column names in the codes."""
    keys = [_need(df, x) for x in (datekey, yearkey, monthkey, daykey)]
    text = col(keys[0]).cast("string")
    if stdnan:
        text = F.when(~is_missing(text), text)
    nothing = F.lit(None).cast("bigint")
    if cvttype:
        y = year_number(col(keys[1]))[0]
        m = limited(col(keys[2]), 12)[0] if keys[2] else nothing
        d = limited(col(keys[3]), 31)[0] if keys[3] else nothing
    else:
        y, m, d = (col(k).cast("bigint") if k else nothing for k in keys[1:])
    code = _mismatch(text, y, m, d)
    for plain, key in (("DATE", keys[0]), ("YEAR", keys[1]), ("MONTH", keys[2]), ("DAY", keys[3])):
        if key:
            code = F.regexp_replace(code, rf"(?<![A-Z]){plain}(?![A-Z])", _code(key))
    return df.withColumn("issue_isdatemismatch", code)


def _units(number: int, level: str) -> str:
    if level not in ("years", "months", "days"):
        raise ValueError("maxinterval_level must be years, months or days")
    return f"INTERVAL {number} {level[:-1].upper()}"


@operator("transformation")
def processdateinterval(
    df: DataFrame,
    datekey: str,
    drop_interval: bool = False,
    strategy: str = "overlap",
    maxinterval_number: int = 1,
    maxinterval_level: str = "years",
    inplace: bool = False,
    flag: bool = True,
) -> DataFrame:
    """Intervals ``start/end`` to one date: their start, end or common part, if not wider than the limit.

    ``drop_interval`` makes intervals null.  A width of 0 counts as 1, −1 means
    no limit, and ``overlap`` has none.  Text of another form, and sides of
    different precision, raise an error.
    """
    if strategy not in ("start", "end", "overlap"):
        raise ValueError("strategy must be start, end or overlap")
    where = resolve(df.columns, datekey, "processdateinterval", inplace)
    if where.source is None:
        raise KeyError(f"no column {datekey}")
    text, code = col(where.source).cast("string"), _code(where.source)
    sides = F.split(text, "/")
    start, end = F.get(sides, F.lit(0)), F.get(sides, F.lit(1))
    formed = text.rlike(VALID_INTERVAL) & (end.isNull() | (F.length(start) == F.length(end)))
    checked = F.when(text.isNull() | formed, text).otherwise(
        F.raise_error(F.concat(F.lit(f"processdateinterval: malformed {where.source}: "), text)).cast("string")
    )
    interval = F.coalesce(F.instr(checked, "/") > 0, F.lit(False))
    first, last = completed(start), completed(end)
    width = F.when(interval, F.datediff(last, first).cast("bigint"))
    (y1, m1, d1), (y2, m2, d2) = partial_parts(start), partial_parts(end)
    common = F.when(
        y1 == y2, F.when(m1 == m2, F.when(d1 == d2, start).otherwise(F.substring(start, 1, 7))).otherwise(F.substring(start, 1, 4))
    )
    unread = interval & (first.isNull() | last.isNull())
    if strategy == "overlap" or maxinterval_number < 0:
        too_wide = F.lit(False)
    else:
        bound = F.expr(_units(max(1, maxinterval_number), maxinterval_level))
        too_wide = interval & F.coalesce(last > (first + bound), F.lit(False))
    picked = {"start": start, "end": end, "overlap": common}[strategy]
    inside = F.lit(None).cast("string") if drop_interval else F.when(~too_wide & ~unread, picked)
    value = F.when(interval, inside).otherwise(checked)
    issue = F.lit(None).cast("string") if drop_interval else _codes(
        F.when(unread, f"{code}_INTERVAL_PROCESSING_FAILED"), F.when(too_wide & ~unread, f"{code}_INTERVAL_EXCEEDS_LIMIT")
    )
    more = {
        f"{base_name(where.source)}_intervalwidth_generatedby_processdateinterval": width,
        "issue_processdateinterval": issue,
    }
    if flag:
        more[f"flag_{base_name(where.source)}_isdateinterval"] = interval
    return put(df.withColumns(more), where, value)


@operator("transformation", keyed=False)
def splitdate(
    df: DataFrame,
    datekey: str,
    yearkey: str | None = None,
    monthkey: str | None = None,
    daykey: str | None = None,
    split: str = "all",
    drop_interval: bool = False,
    drop_mismatch: bool = True,
    inplace_components: bool = False,
    inplace_date: bool = False,
    flag: bool = True,
    strategy: str = "overlap",
    maxinterval_number: int = 1,
    maxinterval_level: str = "years",
) -> DataFrame:
    """Year, month and day from a date, reconciled with the parts there are.

    Four-digit years must agree, shorter ones by their last two digits; months
    and days must be equal.  With ``drop_mismatch`` a wrong year empties
    everything, a wrong month or day everything below it; otherwise only
    ``issue_splitdate`` tells.  Missing keys make ``<part>_generatedby_splitdate``.
    """
    if split not in ("all", "year", "month", "day"):
        raise ValueError("split must be all, year, month or day")
    collapsed = processdateinterval(df, datekey, drop_interval, strategy, maxinterval_number, maxinterval_level, True, flag)
    date_source = resolve(df.columns, datekey, "processdateinterval", True).target
    date = col(date_source)
    parts = list(partial_parts(date))
    names = ("year", "month", "day")
    keys = [current(df.columns, k) if k else None for k in (yearkey, monthkey, daykey)]
    given = [
        year_number(col(keys[0]))[0] if keys[0] else None,
        limited(col(keys[1]), 12)[0] if keys[1] else None,
        limited(col(keys[2]), 31)[0] if keys[2] else None,
    ]
    wrong = []
    for i, g in enumerate(given):
        if g is None:
            wrong.append(F.lit(False))
            continue
        differs = parts[i] != g
        if i == 0:
            differs = F.when(g < 100, parts[i] % 100 != g).otherwise(parts[i] != g)
        wrong.append(F.coalesce(differs, F.lit(False)))
    codes = [F.when(w, f"{_code(k)}_MISMATCH") for w, k in zip(wrong, keys, strict=True) if k]
    value = date
    full = [F.coalesce(p, g) if g is not None and i else p for i, (p, g) in enumerate(zip(parts, given, strict=True))]
    if given[0] is not None:
        full[0] = F.coalesce(parts[0], given[0])
    if drop_mismatch:
        bad_year, bad_month, bad_day = wrong
        bad_month = bad_year | bad_month
        bad_day = bad_month | bad_day
        value = F.when(wrong[0], None).when(bad_month, F.substring(date, 1, 4)).when(bad_day, F.substring(date, 1, 7)).otherwise(date)
        full = [F.when(~b, p) for b, p in zip((bad_year, bad_month, bad_day), full, strict=True)]
    # no month without a year, no day without a month
    full[1] = F.when(full[0].isNotNull(), full[1])
    full[2] = F.when(full[1].isNotNull(), full[2])
    out = collapsed.select("*", _codes(*codes).alias("issue_splitdate"), *(p.cast("bigint").alias(f"__{n}") for p, n in zip(full, names, strict=True)), value.alias("__date"))
    for n, k in zip(names, keys, strict=True):
        if split not in ("all", n):
            continue
        if k is None:
            out = out.withColumn(f"{n}_generatedby_splitdate", F.col(f"__{n}"))
        else:
            out = put(out, resolve(df.columns, k, "splitdate", inplace_components), F.col(f"__{n}"))
    if inplace_date:
        out = out.withColumn(date_source, F.col("__date")).withColumnRenamed(date_source, date_source + "_splitdate")
    else:
        out = out.withColumn(date_source + "_splitdate", F.col("__date"))
    return out.drop("__year", "__month", "__day", "__date")


@operator("transformation", keyed=False)
def temporal(
    df: DataFrame,
    datekey: str,
    yearkey: str | None = None,
    monthkey: str | None = None,
    daykey: str | None = None,
    stdnan: bool = True,
    flag_interval: bool = True,
    drop_interval: bool = False,
    strategy_interval: str = "overlap",
    maxinterval_number: int = 1,
    maxinterval_level: str = "years",
    split_date: str = "all",
    drop_mismatch_split: bool = True,
    inplace_components_split: bool = False,
    inplace_date_split: bool = False,
    dropna_date: bool = False,
) -> DataFrame:
    """Parse, collapse intervals, split and reconcile; optionally drop rows that end without a date."""
    out = parsedate(df, datekey, yearkey, monthkey, daykey, stdnan=stdnan)
    out = splitdate(
        out, datekey, yearkey, monthkey, daykey, split=split_date, drop_interval=drop_interval, drop_mismatch=drop_mismatch_split,
        inplace_components=inplace_components_split, inplace_date=inplace_date_split, flag=flag_interval, strategy=strategy_interval,
        maxinterval_number=maxinterval_number, maxinterval_level=maxinterval_level,
    )
    if dropna_date:
        final = next(c for c in out.columns if c.startswith(base_name(datekey) + "_processedby_") and c.endswith("_splitdate"))
        out = out.where(col(final).isNotNull())
    return out
