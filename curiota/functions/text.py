"""Text expressions: folding to ASCII, quote stripping, transliteration."""

from __future__ import annotations

import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters that do not decompose into a letter and marks.
_LIGATURES = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "ð": "d", "Ð": "D", "þ": "th", "Þ": "Th", "ı": "i", "×": "x", "’": "'", "‘": "'", "“": '"', "”": '"', "–": "-", "—": "-"}


@cache
def _single_letters() -> tuple[str, str]:
    """Accented Latin letters below U+0250 and their ASCII letter, from Unicode's decompositions."""
    pairs = []
    for n in range(0xC0, 0x250):
        plain = unicodedata.normalize("NFKD", chr(n))
        if plain[0].isascii() and all(unicodedata.combining(c) for c in plain[1:]) and plain != chr(n):
            pairs.append((chr(n), plain[0]))
    pairs += [(a, b) for a, b in _LIGATURES.items() if len(b) == 1]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def letters() -> tuple[tuple[str, str], dict[str, str]]:
    """What :func:`fold` replaces: letters by one letter, and letters by several."""
    return _single_letters(), {a: b for a, b in _LIGATURES.items() if len(b) > 1}


def fold(c: Column) -> Column:
    """Latin text in ASCII letters, without Python; other scripts stay as they are."""
    out = F.translate(c, *_single_letters())
    for letter, plain in _LIGATURES.items():
        if len(plain) > 1:
            out = F.replace(out, F.lit(letter), F.lit(plain))
    return out


def fold_text(text: str) -> str:
    """Like :func:`fold`, for use inside Arrow functions; decomposes every script."""
    text = "".join(_LIGATURES.get(c, c) for c in text)
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def fold_any(c: Column) -> Column:
    """Arrow form of :func:`fold_text` for non-Latin scripts."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(fold_text, na_action="ignore")

    return run(c)


def strip_quotes(c: Column) -> Column:
    """Outer runs of double quotes and white space, then of single quotes and white space, removed."""
    once = F.regexp_replace(c, r'^["\s]+|["\s]+$', "")
    return F.regexp_replace(once, r"^['\s]+|['\s]+$", "")


def regex_strip(c: Column, pattern: str | None = None) -> Column:
    """Outer matches of a pattern (white space by default) removed."""
    p = pattern or r"\s"
    return F.regexp_replace(c, f"^(?:{p})+|(?:{p})+$", "")


def normalize_spaces(c: Column) -> Column:
    """Line ends and tabs as spaces, control characters dropped (register fields and queries)."""
    return F.regexp_replace(F.regexp_replace(c, r"[\n\t]", " "), r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")


def repair_encoding(text: str) -> str:
    """UTF-8 that was read as Latin-1, read again; other text unchanged."""
    try:
        return text.encode("latin-1").decode("utf-8")
    except UnicodeError:
        return text
