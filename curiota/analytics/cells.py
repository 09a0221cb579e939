"""Per-cell diversity metrics, robust scores and two-way classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curiota.analytics.species import gini, per_cell


def cell_metrics(df: DataFrame, taxon: str, cell: str, cell_area_km2: float = 1.0, rare: int = 1, common: int = 10) -> DataFrame:
    """Richness, records, distribution of records over taxa, dominance, Gini, Pielou, Simpson and Hill numbers per cell.

    Hill numbers of order 0, 1 and 2 are effective numbers of taxa; evenness divides by richness.
    """
    by = Window.partitionBy("cell")
    counted = per_cell(df, taxon, cell).select(
        "cell",
        "n",
        F.row_number().over(by.orderBy("n", "taxon")).alias("up"),
        F.row_number().over(by.orderBy(F.desc("n"), "taxon")).alias("down"),
        F.sum("n").over(by).alias("total"),
    )
    p = F.col("n") / F.col("total")
    shannon, simpson = -F.sum(p * F.ln(p)), F.sum(p * p)
    richness = F.count("*")
    r8 = lambda c: F.round(c, 8)
    return counted.groupBy("cell").agg(
        richness.alias("richness"),
        F.sum("n").alias("n_records"),
        r8(F.avg("n")).alias("mean_records"),
        F.percentile("n", F.lit(0.5)).alias("median_records"),
        F.percentile("n", F.lit(0.25)).alias("q25_records"),
        F.max("n").alias("max_records"),
        r8(F.count_if(F.col("n") <= rare) / richness).alias("rare_share"),
        r8(F.count_if(F.col("n") >= common) / richness).alias("common_share"),
        r8(F.max("n") / F.sum("n")).alias("top1_share"),
        r8(F.sum(F.when(F.col("down") <= 3, F.col("n")).otherwise(0)) / F.sum("n")).alias("top3_share"),
        r8(gini(F.col("up"), F.col("n"))).alias("gini"),
        r8(1 - gini(F.col("up"), F.col("n"))).alias("one_minus_gini"),
        r8(F.when(richness >= 2, shannon / F.ln(richness))).alias("pielou"),
        r8(1 - simpson).alias("simpson"),
        richness.cast("double").alias("hill_q0"),
        r8(F.exp(shannon)).alias("hill_q1"),
        r8(1 / simpson).alias("hill_q2"),
        r8(F.exp(shannon) / richness).alias("hill_evenness"),
        r8(F.sum("n") / F.lit(cell_area_km2)).alias("records_per_km2"),
    )


def robust_score(df: DataFrame, value: str, output: str = "score", low: float = 0.02, high: float = 0.98) -> DataFrame:
    """``log1p`` clipped to two quantiles and scaled to 0..1; 0.5 where the quantiles meet.

    The quantiles are one row, broadcast.
    """
    x = F.log1p(F.col(value).cast("double"))
    ends = df.agg(F.percentile(x, F.lit(low)).alias("__lo"), F.percentile(x, F.lit(high)).alias("__hi"))
    scaled = (F.least(F.greatest(x, F.col("__lo")), F.col("__hi")) - F.col("__lo")) / (F.col("__hi") - F.col("__lo"))
    return df.join(F.broadcast(ends)).withColumn(output, F.when(F.col("__hi") > F.col("__lo"), scaled).otherwise(F.lit(0.5))).drop("__lo", "__hi")


def bivariate_class(df: DataFrame, a: str, b: str, quantile: float = 0.5, a_threshold: float | None = None, b_threshold: float | None = None) -> DataFrame:
    """``LL, HL, LH, HH`` by strict comparison with thresholds or quantiles, and the joint score √(a·b)."""
    ends = df.agg(F.percentile(F.col(a), F.lit(quantile)).alias("__a"), F.percentile(F.col(b), F.lit(quantile)).alias("__b"))
    limit = lambda given, c: F.lit(given) if given is not None else F.col(c)
    letter = lambda c, t: F.when(F.col(c) > t, "H").otherwise("L")
    known = F.col(a).isNotNull() & F.col(b).isNotNull()
    return (
        df.join(F.broadcast(ends))
        .withColumn("class", F.when(known, F.concat(letter(a, limit(a_threshold, "__a")), letter(b, limit(b_threshold, "__b")))))
        .withColumn("joint_score", F.sqrt(F.col(a) * F.col(b)))
        .drop("__a", "__b")
    )


def boundary(richness: Column, n: Column, evenness: Column, volume_class: Column, rare_share: Column) -> Column:
    """Cells to outline: uneven ones with enough data, and high-volume ones of rare taxa."""
    uneven = (richness >= 5) & (n >= 20) & (evenness < 0.75)
    return F.coalesce(uneven | ((volume_class == "H") & (rare_share >= 0.8)), F.lit(False))
