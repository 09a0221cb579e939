"""Readers and writers for delimited text, Parquet and compressed files."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from curiota.functions.durable import durable
from curiota.functions.naming import col
from curiota.functions.nulls import stdnan
from curiota.functions.text import strip_quotes

CORRUPT = "__corrupt"


def header(spark: SparkSession, path: str, sep: str = "\t") -> list[str]:
    """Column names of the first line, quotes stripped; read through Spark, so any store works."""
    line = spark.read.text(path).first()
    return [n.strip(" \"'") for n in line[0].split(sep)] if line else []


def read_text(spark: SparkSession, path: str, sep: str = "\t", columns: list[str] | None = None, lenient: bool = False, strip: bool = True) -> DataFrame:
    """Delimited text with every column a string; quotes are data, outer ones are stripped.

    A row with too many or too few fields is an error; ``lenient`` makes it a
    row of nulls instead.  Gzip files are read by their extension.
    """
    names = header(spark, path, sep)
    lines = spark.read.text(path).withColumnRenamed("value", "__line")
    head = sep.join(names)
    raw = F.split(F.col("__line"), "\t" if sep == "\t" else "\\" + sep, -1)
    whole = F.size(raw) == len(names)
    checked = F.when(whole, raw) if lenient else F.when(whole, raw).otherwise(
        F.raise_error(F.concat(F.lit(f"expected {len(names)} fields: "), F.col("__line"))).cast("array<string>")
    )
    body = lines.where(F.regexp_replace("__line", "[ \"']", "") != F.lit(head.replace(" ", "").replace('"', "").replace("'", "")))
    fields = body.select(checked.alias("f"))
    wanted = [n for n in names if columns is None or n in columns]
    value = lambda n: F.get("f", F.lit(names.index(n)))
    return fields.select(*((strip_quotes(value(n)) if strip else value(n)).alias(n) for n in wanted))


def read_csv(spark: SparkSession, path: str, sep: str = ",", columns: list[str] | None = None, lenient: bool = False) -> DataFrame:
    """Quoted CSV with every column a string; malformed rows are an error, or rows of nulls."""
    names = spark.read.option("header", True).option("sep", sep).csv(path).columns
    schema = StructType([StructField(n, StringType()) for n in names])
    reader = spark.read.option("header", True).option("sep", sep)
    if not lenient:
        out = reader.option("mode", "FAILFAST").schema(schema).csv(path)
    else:
        marked = StructType([*schema.fields, StructField(CORRUPT, StringType())])
        out = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).schema(marked).csv(path)
        out = out.select(*(F.when(F.col(CORRUPT).isNull(), col(n)).alias(n) for n in names))
    return extract_columns(out, columns) if columns else out


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return extract_columns(df, columns) if columns else df


def sniff(spark: SparkSession, path: str) -> str:
    """``parquet``, ``gzip`` or ``text`` by the first bytes of a file, read through Spark."""
    first = spark.read.format("binaryFile").load(path).select(F.substring("content", 1, 4).alias("b")).first()
    magic = bytes(first["b"]) if first else b""
    return "parquet" if magic == b"PAR1" else "gzip" if magic[:2] == b"\x1f\x8b" else "text"


def read_auto(spark: SparkSession, path: str, sep: str = "\t", columns: list[str] | None = None) -> DataFrame:
    """The reader that fits the file."""
    if path.rstrip("/").endswith(".parquet") or sniff(spark, path) == "parquet":
        return read_parquet(spark, path, columns)
    return read_text(spark, path, sep, columns)


def extract_columns(df: DataFrame, names: list[str] | None = None, indices: list[int] | None = None) -> DataFrame:
    """Columns by name or by 1-based position; the scan reads no others."""
    picked = list(names or []) + [df.columns[i - 1] for i in indices or []]
    return df.select(*(col(c) for c in picked))


def with_row_id(df: DataFrame, name: str = "row_id", start: int = 2, order: list[str] | None = None) -> DataFrame:
    """Consecutive numbers in scan order, or in the order of key columns.

    Each partition counts its rows; the offsets (one number per partition) go
    back as a literal map.  Rows are written with their place first: another run
    of a sort or a scan may cut its partitions elsewhere.  Null keys come last.
    The first data row of a file with a header is 2.
    """
    ordered = df.orderBy(*(col(c).asc_nulls_last() for c in order)) if order else df
    marked = durable(ordered.withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)
    sizes = {r["p"]: r["n"] for r in marked.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    offsets, total = [], start
    for p in sorted(sizes):
        offsets += [F.lit(p), F.lit(total)]
        total += sizes[p]
    if not offsets:
        return df.withColumn(name, F.lit(None).cast("bigint"))
    within = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return marked.withColumn(name, (F.element_at(F.create_map(*offsets), part) + within).cast("bigint")).drop("__at")


ADAPTERS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def source_adapter(name: str):
    """Register a function that brings a dataset into the common column names."""

    def add(function):
        ADAPTERS[name] = function
        return function

    return add


def mapped(df: DataFrame, names: dict[str, str], constants: dict[str, str] | None = None, binomial: tuple[str, str] | None = None, row_id: str | None = None) -> DataFrame:
    """Rename columns, null-normalize, build ``scientificName`` from two columns (null if either is), add constants and a row id."""
    out = stdnan(df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns}))
    if binomial:
        out = out.withColumn("scientificName", F.concat(col(binomial[0]), F.lit(" "), col(binomial[1])))
    for name, value in (constants or {}).items():
        out = out.withColumn(name, F.lit(value))
    return with_row_id(out, row_id, start=0) if row_id else out


#: A net-tow dataset's columns and their Darwin Core names.
NET_TOWS = {
    "lat": "decimalLatitude", "lon": "decimalLongitude", "date": "eventDate", "year": "year", "month": "month", "day": "day",
    "time_local": "eventTime", "depth": "verbatimDepth", "depth_upper": "minimumDepthInMeters", "depth_lower": "maximumDepthInMeters",
    "rank_species": "specificEpithet", "rank_genus": "genus", "rank_family": "family", "rank_order": "order", "rank_class": "class",
    "rank_phylum": "phylum", "taxon": "originalScientificName", "presence_absence": "occurrenceStatus", "owner_dataset": "datasetName",
    "project_title": "projectTitle", "location_name": "locality", "collection_method": "samplingProtocol", "study_type": "basisOfRecord",
}


@source_adapter("jedi")
def net_tows(df: DataFrame) -> DataFrame:
    return mapped(df, NET_TOWS, {"kingdom": "Animalia"}, ("genus", "specificEpithet"), "jedi_id")


def write_text(df: DataFrame, path: str, sep: str = "\t", mode: str = "errorifexists", order: str | None = None) -> None:
    """Delimited text with a header; ``order`` range-sorts, so part files concatenate in that order."""
    out = df.repartitionByRange(col(order)).sortWithinPartitions(col(order)) if order else df
    out.write.mode(mode).option("sep", sep).option("header", True).option("quote", "").option("emptyValue", "").csv(path)


def dtypes_json(df: DataFrame) -> str:
    return json.dumps(dict(df.dtypes), indent=2)


def resume_after(df: DataFrame, done: DataFrame, row_id: str) -> DataFrame:
    """Rows not written yet."""
    return df.join(done.select(col(row_id)), row_id, "left_anti")


def observed(df: DataFrame, name: str, *more: Column) -> DataFrame:
    """Attach row counting to a step; the numbers come with the action that runs the plan."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *more)
