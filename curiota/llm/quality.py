"""Operator 4: quality rules as a short-circuit cascade (DataFrame functions only).

Each rule is a predicate over metrics of the text.  Its cost (characters and
words that it visits) and selectivity (share rejected) are estimated on a
sample; rules run in order of rejection per cost, inside one CASE expression, so
a document's later rules, and the metrics that only they need, are not evaluated
once one has rejected it.  The sample is drawn by a hash of id and text over the
whole table, and costs are counted, not timed, so one table always gives one
order.  The order never changes the verdict, only which of several rules that
reject a text is named.

A null text has no words and is rejected like an empty one.  Rows are
independent: ids may repeat or be null, and ties do not arise (rules that tie go
in the given order).  An empty table gives an empty result.  Very long texts are
measured whole.  Other columns are not read, so their names cannot clash.  Words
are runs of characters other than space, tab, line feed, vertical tab, form feed
and carriage return.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space between words, and the symbols that are counted.
WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _count_of(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def _duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, WHITE, "") != "")
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def _windows(words: Column) -> Column:
    """Hashes of the three-word windows by position."""
    last = F.size(words) - 3
    return F.when(
        last >= 0,
        F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def _covered_by_repeats(windows: Column) -> Column:
    """Words inside windows whose hash occurs at least twice."""
    ranked = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    following = F.slice(ranked, 2, F.greatest(F.size(ranked) - 1, F.lit(0)))
    # neighbours in hash order with one hash: both ends are repeats
    pairs = F.filter(
        F.zip_with(ranked, following, lambda a, b: F.struct(a["h"].alias("h"), a["i"].alias("i"), b["h"].alias("g"), b["i"].alias("j"))),
        lambda p: p["h"] == p["g"],
    )
    covered = F.flatten(
        F.transform(pairs, lambda p: F.array(p["i"], p["i"] + 1, p["i"] + 2, p["j"], p["j"] + 1, p["j"] + 2))
    )
    return F.size(F.array_distinct(covered)).cast("long")


@dataclass(frozen=True)
class Rule:
    """Rejects a text where ``rejects`` holds.

    ``rejects`` gets the columns n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words and the text, and must not be null.
    """

    name: str
    rejects: Callable[[dict[str, Column]], Column]
    #: characters and words that the rule visits
    work: Callable[[dict[str, Column]], Column]


def production_rules() -> list[Rule]:
    characters = lambda m: F.length(m["text"])
    return [
        Rule("too_few_words", lambda m: m["n_words"] < 50, characters),
        # three words are hashed for every window, and windows are sorted
        Rule("repeated_windows", lambda m: m["n_repeat_words"] * 100 > m["n_words"] * 50, lambda m: characters(m) + m["n_words"] * (3 + F.log2(m["n_words"] + 2))),
        Rule("symbols", lambda m: m["n_symbols"] * 10 > m["n_words"], lambda m: 2 * characters(m)),
        Rule("duplicate_lines", lambda m: m["n_dup_lines"] * 100 > 50 * F.greatest(m["n_lines"], F.lit(1)), lambda m: 2 * characters(m)),
        Rule("word_length", lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 15 * m["n_words"]), lambda m: 2 * characters(m)),
        Rule(
            "wordless_tokens",
            lambda m: F.size(F.filter(words_of(m["text"]), lambda w: w.rlike(r"\p{L}"))) * 100 < 70 * m["n_words"],
            lambda m: characters(m) + m["n_words"],
        ),
    ]


BASE_RULES = ("too_few_words", "repeated_windows")


def with_metrics(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``id, text`` and the five metrics, each staged so that nothing is computed twice."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    staged = df.select(F.col(f"`{id_col}`").alias("id"), text.alias("text")).withColumn("words", words_of(F.col("text")))
    staged = staged.select(
        "id",
        "text",
        F.size("words").cast("long").alias("n_words"),
        (F.length("text") - _count_of(F.col("text"), WHITE)).cast("long").alias("word_chars"),
        _count_of(F.col("text"), SYMBOLS).alias("n_symbols"),
        _duplicate_lines(F.col("text")).alias("n_dup_lines"),
        F.size(F.filter(F.split("text", "\n"), lambda x: F.translate(x, WHITE, "") != "")).cast("long").alias("n_lines"),
        _windows(F.col("words")).alias("windows"),
    )
    repeats = F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"), _covered_by_repeats(F.col("windows"))
    ).otherwise(F.lit(0).cast("long"))
    return staged.withColumn("n_repeat_words", repeats).drop("windows")


def _metric_columns() -> dict[str, Column]:
    names = ("text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")
    return {n: F.col(n) for n in names}


def _metric_expressions() -> dict[str, Column]:
    """The metrics as expressions over ``text``: what no rule that is reached needs is not computed."""
    text, words = F.col("text"), words_of(F.col("text"))
    return {
        "text": text,
        "n_words": F.size(words).cast("long"),
        "word_chars": (F.length(text) - _count_of(text, WHITE)).cast("long"),
        "n_symbols": _count_of(text, SYMBOLS),
        "n_dup_lines": _duplicate_lines(text),
        "n_lines": F.size(F.filter(F.split(text, "\n"), lambda x: F.translate(x, WHITE, "") != "")).cast("long"),
        "n_repeat_words": _covered_by_repeats(_windows(words)),
    }


def order_rules(df: DataFrame, rules: Sequence[Rule], sample_rows: int, id_col: str = "doc_id", text_col: str = "text") -> list[Rule]:
    """Rules by rejected rows per unit of work, on the ``sample_rows`` rows of the least hash of id and text."""
    hashed = df.select(
        F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("h"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")
    )
    least = hashed.select("h").orderBy("h").limit(sample_rows).agg(F.max("h")).first()[0]
    # rows that repeat id and text have one hash and count once
    sample = with_metrics(hashed.where(F.col("h") <= F.lit(least).cast("bigint")).dropDuplicates(["h"]).select("id", "text"), "text", "id")
    m = _metric_columns()
    found = sample.agg(
        *(F.count_if(r.rejects(m)).alias(f"r{i}") for i, r in enumerate(rules)),
        *(F.coalesce(F.sum(r.work(m).cast("double")), F.lit(0.0)).alias(f"w{i}") for i, r in enumerate(rules)),
    ).first()
    return [rules[i] for i in sorted(range(len(rules)), key=lambda i: (-found[f"r{i}"] / max(found[f"w{i}"], 1.0), i))]


def verdict_of(rules: Sequence[Rule], metrics: dict[str, Column]) -> Column:
    """The name of the first rule that rejects, or null; later rules are not evaluated."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(rule.rejects(metrics), F.lit(rule.name)).otherwise(verdict)
    return verdict


def keep(df: DataFrame, rules: Sequence[Rule] | None = None, sample_rows: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that no rule rejects; a row's metrics are computed up to the rule that rejects it."""
    ordered = order_rules(df, list(rules or production_rules()), sample_rows, id_col, text_col)
    staged = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return staged.where(verdict_of(ordered, _metric_expressions()).isNull()).select(*(F.col(f"row.`{c}`").alias(c) for c in df.columns))


def cascade(
    df: DataFrame,
    rules: Sequence[Rule] | None = None,
    sample_rows: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id``, the metrics, ``base_failed``, ``kept`` and ``rejected_by``.

    All metrics are asked for here; :func:`keep` computes no more than a verdict
    needs.  ``sample_rows`` bounds the rows on which cost and selectivity are
    estimated; it decides the order of evaluation only.
    """
    rules = list(rules or production_rules())
    measured = with_metrics(df, text_col, id_col)
    columns = _metric_columns()
    verdict = verdict_of(order_rules(df, rules, sample_rows, id_col, text_col), columns)
    base = F.lit(False)
    for rule in rules:
        if rule.name in BASE_RULES:
            base = base | rule.rejects(columns)
    return measured.select(
        F.col("id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.alias("base_failed"),
        verdict.alias("rejected_by"),
    ).withColumn("kept", F.col("rejected_by").isNull())
