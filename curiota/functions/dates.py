"""Partial dates ``YYYY[-MM[-DD]]`` as text, and calendar arithmetic on them (ANSI-safe)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VALID_PARTIAL = r"^\d{4}(-\d{2}(-\d{2})?)?$"
VALID_INTERVAL = r"^\d{4}(-\d{2}(-\d{2})?)?(/\d{4}(-\d{2}(-\d{2})?)?)?$"

#: Month names and short forms in several European languages.
MONTHS = {
    1: ["january", "jan", "janvier", "januar", "enero", "gennaio", "janeiro", "januari"],
    2: ["february", "feb", "fevrier", "fev", "februar", "febrero", "febbraio", "fevereiro", "februari"],
    3: ["march", "mar", "mars", "marz", "maerz", "marzo", "marco", "maart"],
    4: ["april", "apr", "avril", "avr", "abril", "abr", "aprile"],
    5: ["may", "mai", "mayo", "maggio", "maio", "mei", "maj"],
    6: ["june", "jun", "juin", "juni", "junio", "giugno", "junho"],
    7: ["july", "jul", "juillet", "juil", "juli", "julio", "luglio", "julho"],
    8: ["august", "aug", "aout", "agosto", "ago", "augustus", "augusti"],
    9: ["september", "sep", "sept", "septembre", "septiembre", "settembre", "setembro"],
    10: ["october", "oct", "octobre", "oktober", "okt", "octubre", "ottobre", "outubro"],
    11: ["november", "nov", "novembre", "noviembre", "novembro"],
    12: ["december", "dec", "decembre", "dezember", "dez", "diciembre", "dic", "dicembre", "dezembro"],
}


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` mentions it.

    Staged projections would not do: a filter pushed below them puts every
    mention back in full.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def month_number(word: Column) -> Column:
    """Month of a lower-case ASCII month word; null for other words.  The lookup table is one literal."""
    pairs = ", ".join(f"'{w}', {n}" for n, words in MONTHS.items() for w in words)
    return F.try_element_at(F.expr(f"map({pairs})"), word)


def is_leap(year: Column) -> Column:
    return ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)


def days_in_month(year: Column, month: Column) -> Column:
    """Days of a month; null for a month outside 1 to 12.  February of an unknown year has 29."""
    return (
        F.when(month.isin(1, 3, 5, 7, 8, 10, 12), 31)
        .when(month.isin(4, 6, 9, 11), 30)
        .when(month == 2, F.when(F.coalesce(is_leap(year), F.lit(True)), 29).otherwise(28))
    )


def partial_parts(text: Column) -> tuple[Column, Column, Column]:
    """Year, month and day of a partial date; null where absent or not a number."""
    parts = F.split(text, "-")
    return tuple(F.get(parts, F.lit(i)).try_cast("int") for i in range(3))


def completed(text: Column) -> Column:
    """A partial date as a date, missing month and day taken as 1; null if impossible."""
    return F.when(text.rlike(VALID_PARTIAL), F.concat(text, F.when(F.length(text) == 4, "-01-01").when(F.length(text) == 7, "-01").otherwise(""))).try_cast("date")


def two(n: Column) -> Column:
    return F.lpad(n.cast("string"), 2, "0")


def joined(year: Column, month: Column, day: Column) -> Column:
    """``YYYY[-MM[-DD]]`` from parts, as far as they go without a gap; null without a year."""
    y = F.lpad(year.cast("string"), 4, "0")
    return F.when(
        year.isNotNull(),
        F.concat(
            y,
            F.when(month.isNotNull(), F.concat(F.lit("-"), two(month))).otherwise(""),
            F.when(month.isNotNull() & day.isNotNull(), F.concat(F.lit("-"), two(day))).otherwise(""),
        ),
    )
