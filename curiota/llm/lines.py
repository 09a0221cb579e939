"""Operator 10: exact line deduplication across documents.

Texts are split at line feeds; a line's key is the line without surrounding
white space and with A-Z lower-cased.  Keys of at least ``min_chars`` code
points found in at least ``min_docs`` documents lose all their lines except
those of the largest id that holds them.

A null or empty text is one empty line.  Rows that repeat an id are one
document for counting, and each loses the same keys; rows without an id count
as one document together and lose nothing.  Keys travel as two
64-bit hashes.  Counting is pre-aggregated per task, first by key and document
and then by key, so a line that a third of all documents hold is a handful of
partial counts; dropping is an equality join of two written tables, whose large
partitions Spark splits.  Only texts that lose a line are reassembled, by
position, in Python.  Ties cannot arise: the largest id is one document.  An
empty table gives an empty one, very long texts are lines like others, and
other columns travel in a struct, whatever their names.
"""

from __future__ import annotations

import struct

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from curiota.llm.arrow import ensure_checkpoint_dir

#: White space that is stripped from keys, and case folding of ASCII letters only.
STRIPPED = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_FOLD = str.maketrans(UPPER, LOWER)
#: Spark chains the hashes of its arguments: the second hash starts from that of the integer 1.
_SEEDS = (42, xxhash.xxh64_intdigest(struct.pack("<i", 1), 42))


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(STRIPPED)), UPPER, LOWER)


def _key_hash(line: str) -> tuple[int, int]:
    key = line.strip(STRIPPED).translate(_FOLD).encode("utf-8")
    a, b = (xxhash.xxh64_intdigest(key, seed) for seed in _SEEDS)
    return a - (a >> 63 << 64), b - (b >> 63 << 64)


def drops(df: DataFrame, min_chars: int, min_docs: int, id_col: str, text_col: str) -> DataFrame:
    """``id, gone array<struct<a,b>>``: the hashed keys that each document loses."""
    ensure_checkpoint_dir(df.sparkSession)
    # written once: both the counts and the lookup read it, and a task that is lost does not split all texts again
    held = (
        df.select(F.col(f"`{id_col}`").alias("id"), F.explode(F.split(F.col(f"`{text_col}`"), "\n")).alias("line"))
        .where(F.length("line") >= min_chars)
        .select("id", line_key(F.col("line")).alias("key"))
        .where(F.length("key") >= min_chars)
        .select("id", F.xxhash64("key").alias("a"), F.xxhash64(F.lit(1), F.col("key")).alias("b"))
        .distinct()
        .checkpoint()
    )
    # written too, so that nothing stands between the join and its shuffles: Spark splits the partitions of a hot key
    common = (
        held.groupBy("a", "b")
        .agg(F.count("*").alias("n"), F.max("id").alias("keeper"))
        .where(F.col("n") >= min_docs)
        .drop("n")
        .checkpoint()
    )
    lost = held.where("id IS NOT NULL").join(common, ["a", "b"]).where(F.col("id") != F.col("keeper"))
    return lost.groupBy("id").agg(F.collect_list(F.struct("a", "b")).alias("gone"))


@F.pandas_udf(StructType([StructField("kept", StringType()), StructField("n", LongType())]))
def _without(texts: pd.Series, first: pd.Series, second: pd.Series) -> pd.DataFrame:
    """Texts without the lines whose key hashes to one of the given pairs, and the lines left."""

    def one(text, a, b):
        if text is None or a is None:
            return None, None
        gone = set(zip(a.tolist(), b.tolist(), strict=True))
        left = [x for x in text.split("\n") if _key_hash(x) not in gone]
        return "\n".join(left), len(left)

    rows = [one(*x) for x in zip(texts, first, second, strict=True)]
    return pd.DataFrame({"kept": [r[0] for r in rows], "n": pd.array([r[1] for r in rows], dtype="Int64")})


def _free(columns: list[str]) -> str:
    """A name that no column has in any case; a struct needs one field."""
    taken = {c.lower() for c in columns}
    return next(n for n in ("_" * k for k in range(1, len(taken) + 3)) if n not in taken)


def dedup_lines(
    df: DataFrame, min_chars: int = 40, min_docs: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, kept_text, n_lines, n_dropped`` and, as ``row``, the input row as a struct."""
    packed = df.select(
        F.col(f"`{id_col}`").alias("id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
        F.struct(F.lit(0).alias(_free(df.columns)), *(F.col(f"`{c}`") for c in df.columns if c not in (id_col, text_col))).alias("row"),
    )
    gone = drops(df, min_chars, min_docs, id_col, text_col).withColumnRenamed("id", "lost_id")
    touched = packed.join(gone, F.col("id") == F.col("lost_id"), "left")
    redone = _without(F.when(F.col("gone").isNotNull(), F.col("text")), F.col("gone.a"), F.col("gone.b"))
    n_lines = (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("long")
    return touched.select("id", "text", "row", n_lines.alias("n_lines"), redone.alias("redone")).select(
        F.col("id").alias(id_col),
        F.coalesce("redone.kept", "text").alias("kept_text"),
        "n_lines",
        (F.col("n_lines") - F.coalesce("redone.n", "n_lines")).alias("n_dropped"),
        "row",
    )


def drop_lines(
    df: DataFrame,
    min_chars: int = 40,
    min_docs: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
    length_col: str | None = "n_chars",
) -> DataFrame:
    """``df`` with the lost lines cut out of its texts; a length column, if there is one, follows."""
    done = dedup_lines(df, min_chars, min_docs, id_col, text_col)

    def column(c: str) -> Column:
        if c == id_col:
            return F.col(f"`{c}`")
        if c == text_col:
            return F.col("kept_text").alias(c)
        if c == length_col:
            return F.when(F.col("n_dropped") > 0, F.length("kept_text").cast(df.schema[c].dataType)).otherwise(F.col(f"row.`{c}`")).alias(c)
        return F.col(f"row.`{c}`").alias(c)

    return done.select(*map(column, df.columns))
