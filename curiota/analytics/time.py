"""Record counts over years and months."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curiota.functions.naming import col


def records_by_year(df: DataFrame, year: str, first: int = 1950) -> DataFrame:
    """Records per year; years up to ``first`` share a bucket."""
    bucket = F.when(col(year) <= first, F.lit(first)).otherwise(col(year)).cast("bigint")
    return df.where(col(year).isNotNull()).groupBy(bucket.alias("year")).agg(F.count("*").alias("n"))


def records_by_month(df: DataFrame, month: str) -> DataFrame:
    return df.where(col(month).isNotNull()).groupBy(col(month).cast("bigint").alias("month")).agg(F.count("*").alias("n"))


def month_year_counts(df: DataFrame, year: str, month: str) -> DataFrame:
    """Year by month matrix with zeros; column ``13`` counts unknown months."""
    m = F.coalesce(col(month).cast("int"), F.lit(13))
    return df.where(col(year).isNotNull()).groupBy(col(year).cast("bigint").alias("year")).agg(
        *(F.count_if(m == i).alias(str(i)) for i in range(1, 14))
    )


def month_year_share(df: DataFrame, year: str, month: str, include_unknown: bool = False) -> DataFrame:
    """Percentage of a year's records per month, over known months or all, and the unknown share of all."""
    counts = month_year_counts(df, year, month)
    known = sum((F.col(str(i)) for i in range(2, 13)), F.col("1"))
    every = known + F.col("13")
    base = every if include_unknown else known
    return counts.select(
        "year", *(F.when(base > 0, F.round(100.0 * F.col(str(i)) / base, 8)).alias(str(i)) for i in range(1, 13)), F.round(100.0 * F.col("13") / every, 8).alias("unknown")
    )


def window_summary(df: DataFrame, key: str) -> DataFrame:
    """Least, greatest and mean of a column."""
    return df.agg(F.min(col(key)).alias("low"), F.max(col(key)).alias("high"), F.avg(col(key)).alias("mean"))
