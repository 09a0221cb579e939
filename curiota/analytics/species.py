"""Per-taxon statistics: concentration, inequality, evenness, summaries.  Built-in aggregates only."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curiota.functions.naming import col
from curiota.functions.nulls import stdnan


def prepared(df: DataFrame, lat: str, lon: str, grid, resolution: int) -> DataFrame:
    """Null-normalized occurrences with their grid cell as ``cell`` and its area."""
    clean = stdnan(df)
    cell = grid.cell(col(lat).try_cast("double"), col(lon).try_cast("double"), resolution)
    return clean.withColumn("cell", cell).withColumn("cell_area_km2", grid.area_km2(F.col("cell"), resolution))


def gini(ranked: Column, value: Column) -> Column:
    """Normalized Gini of a group from ascending ranks (1-based) of its values; 0 for one value."""
    n, total = F.count(value), F.sum(value)
    raw = 2 * F.sum(ranked * value) / (n * total) - (n + 1) / n
    return F.when(n == 1, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw * n / (n - 1))))


def pielou(share: Column) -> Column:
    """Shannon entropy of shares over its maximum; null below two values."""
    n = F.count(share)
    return F.when(n >= 2, -F.sum(share * F.ln(share)) / F.ln(n))


def per_cell(df: DataFrame, taxon: str, cell: str) -> DataFrame:
    """``taxon, cell, n``: the table the statistics start from, aggregated before anything meets."""
    return df.where(col(taxon).isNotNull() & col(cell).isNotNull()).groupBy(col(taxon).alias("taxon"), col(cell).alias("cell")).agg(F.count("*").alias("n"))


def species_stats(df: DataFrame, taxon: str, cell: str, cell_area_km2: float = 1.0, share: float = 0.9) -> DataFrame:
    """Per taxon: records, occupied cells and area, density, cells that hold ``share`` of the records, Gini, Pielou."""
    by = Window.partitionBy("taxon")
    down = by.orderBy(F.desc("n"), "cell").rowsBetween(Window.unboundedPreceding, 0)
    counted = per_cell(df, taxon, cell).select(
        "taxon",
        "n",
        F.row_number().over(by.orderBy("n", "cell")).alias("rank"),
        F.sum("n").over(by).alias("total"),
        F.sum("n").over(down).alias("running"),
    )
    before = F.col("running") - F.col("n")
    area = F.count("*") * F.lit(cell_area_km2)
    return counted.groupBy("taxon").agg(
        F.sum("n").alias("n_records"),
        F.count("*").alias("n_cells"),
        area.alias("occupied_km2"),
        (F.sum("n") / area).alias("density_per_km2"),
        F.floor(F.sum("n") / area).alias("records_per_occupied_km2"),
        F.count_if(before < share * F.col("total")).alias("cells_for_share"),
        (100.0 * F.count_if(before < share * F.col("total")) / F.count("*")).alias("pct_cells_for_share"),
        (100.0 * F.max("n") / F.sum("n")).alias("max_cell_pct"),
        gini(F.col("rank"), F.col("n")).alias("gini"),
        F.round(pielou(F.col("n") / F.col("total")), 2).alias("pielou"),
    )


def top_species(df: DataFrame, taxon: str, k: int = 10) -> DataFrame:
    """The ``k`` taxa with most records and their percentage of all."""
    counts = df.where(col(taxon).isNotNull()).groupBy(col(taxon).alias("taxon")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    top = counts.orderBy(F.desc("n"), "taxon").limit(k)
    return top.join(F.broadcast(total)).select("taxon", "n", (100.0 * F.col("n") / F.col("total")).alias("pct"))


def rank_summary(df: DataFrame, ranks: list[str]) -> DataFrame:
    """Rows, and distinct values of each rank: one row."""
    return df.agg(F.count("*").alias("n_records"), *(F.countDistinct(col(r)).alias(f"n_{r}") for r in ranks))


def count_summary(df: DataFrame, taxon: str, thresholds: tuple[int, ...] = (10, 50, 100)) -> DataFrame:
    """Quartiles and maximum of records per taxon, how many taxa reach or miss each threshold, and their percentage."""
    counts = df.where(col(taxon).isNotNull()).groupBy(col(taxon)).agg(F.count("*").alias("n"))
    at = lambda q: F.percentile("n", F.lit(q))
    reach = [x for t in thresholds for x in (
        F.count_if(F.col("n") >= t).alias(f"n_{t}"),
        (100.0 * F.count_if(F.col("n") >= t) / F.count("*")).alias(f"pct_{t}"),
        F.count_if(F.col("n") < t).alias(f"n_below_{t}"),
    )]
    return counts.agg(
        F.count("*").alias("n_taxa"), at(0.25).alias("q25"), at(0.5).alias("median"), at(0.75).alias("q75"), F.max("n").alias("most"), *reach
    )


def top_shares(df: DataFrame, taxon: str, ks: tuple[int, ...] = (1, 10, 100), share: float = 0.5) -> DataFrame:
    """Percentage of records in the top k taxa, and how many taxa hold ``share`` of the records.

    The running sum goes over counts of counts, whose rows are few however many taxa there are.
    """
    counts = df.where(col(taxon).isNotNull()).groupBy(col(taxon)).agg(F.count("*").alias("n"))
    levels = counts.groupBy("n").agg(F.count("*").alias("m"))
    above = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    run = levels.select("n", "m", F.coalesce(F.sum("m").over(above), F.lit(0)).alias("before"), F.coalesce(F.sum(F.col("n") * F.col("m")).over(above), F.lit(0)).alias("held"))
    total = F.sum(F.col("n") * F.col("m"))
    run = run.join(F.broadcast(run.agg(total.alias("total"))))
    top = [
        (100.0 * F.sum(F.col("n") * F.greatest(F.lit(0), F.least(F.col("m"), F.lit(k) - F.col("before")))) / F.first("total")).alias(f"pct_top_{k}")
        for k in ks
    ]
    need = F.ceil((share * F.col("total") - F.col("held")) / F.col("n"))
    dominant = F.sum(F.greatest(F.lit(0), F.least(F.col("m"), need))).alias("n_dominant")
    return run.agg(*top, dominant)


def frequencies(df: DataFrame, key: str, k: int | None = None) -> DataFrame:
    """Rows per value (null included) and percentage of all."""
    counts = df.groupBy(col(key).alias("value")).agg(F.count("*").alias("n"))
    out = counts.join(F.broadcast(counts.agg(F.sum("n").alias("total")))).select("value", "n", (100.0 * F.col("n") / F.col("total")).alias("pct"))
    return out.orderBy(F.desc("n"), "value").limit(k) if k else out


def taxa_per_group(df: DataFrame, group: str, taxon: str) -> DataFrame:
    """Records and distinct taxa per kingdom, phylum or any other group."""
    return df.groupBy(col(group).alias("group")).agg(F.count("*").alias("n_records"), F.countDistinct(col(taxon)).alias("n_taxa"))


def year_quantiles(df: DataFrame, year: str, qs: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    return df.agg(*(F.percentile(col(year), F.lit(q)).alias(f"year_q{round(100 * q)}") for q in qs))


def grid_occupancy(df: DataFrame, taxon: str, cell: str, thresholds: tuple[int, ...] = (1, 5, 10, 50, 100)) -> DataFrame:
    """For each threshold, how many taxa (and what percentage) occupy at least so many cells."""
    cells = per_cell(df, taxon, cell).groupBy("taxon").agg(F.count("*").alias("cells"))
    asked = [x for t in thresholds for x in (F.count_if(F.col("cells") >= t).alias(f"n{t}"),)]
    one = cells.agg(F.count("*").alias("total"), *asked)
    rows = F.array(*(F.struct(F.lit(t).alias("threshold"), F.col(f"n{t}").alias("n_taxa")) for t in thresholds))
    return one.select(F.explode(rows).alias("r"), "total").select("r.threshold", "r.n_taxa", (100.0 * F.col("r.n_taxa") / F.col("total")).alias("pct_taxa"))


def occurrence_threshold(df: DataFrame, taxon: str, most: int = 1000) -> DataFrame:
    """For t = 1..most, the number of taxa with at least t records."""
    counts = df.where(col(taxon).isNotNull()).groupBy(col(taxon)).agg(F.least(F.count("*"), F.lit(most)).alias("n"))
    levels = counts.groupBy("n").agg(F.count("*").alias("m"))
    axis = df.sparkSession.range(1, most + 1).toDF("threshold")
    up = Window.orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    joined = axis.join(levels, F.col("threshold") == F.col("n"), "left")
    return joined.select("threshold", F.sum(F.coalesce("m", F.lit(0))).over(up).alias("n_taxa"))


def add_names(df: DataFrame, names: DataFrame, key: str, name: str = "scientificname") -> DataFrame:
    """Display names by id; Spark broadcasts the name table if it is small."""
    return df.join(names.select(F.col("id").alias("__id"), F.col(name).alias(f"{key}_name")), col(key).cast("string") == F.col("__id"), "left").drop("__id")


def dataset_statistics(df: DataFrame, taxon: str, cell: str, year: str | None = None, ranks: list[str] | None = None) -> dict:
    """The summaries as one dictionary of plain values; each is a small aggregate."""
    one = lambda d: d.first().asDict()
    out = {"records": one(count_summary(df, taxon)), "shares": one(top_shares(df, taxon)), "occupancy": [r.asDict() for r in grid_occupancy(df, taxon, cell).collect()]}
    if ranks:
        out["ranks"] = one(rank_summary(df, ranks))
    if year:
        out["years"] = one(year_quantiles(df, year))
    return out


def to_json(summary: dict) -> str:
    return json.dumps(summary, indent=2, sort_keys=True, default=str)
