"""Taxon identifiers and quotas: rare taxa out, common taxa sampled evenly in space."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curiota.functions.naming import col
from curiota.operators.registry import operator
from curiota.providers.grid import EqualAreaGrid, Grid

RANKS = ["species", "genus", "family", "order", "class", "phylum", "kingdom"]


def taxon_key(ranks: list[str]) -> Column:
    """A canonical id of a rank tuple, nulls being values; null without a species or without any higher rank.

    A hash instead of a dense number: no sort and no shuffle.  The marker of
    nulls keeps tuples apart that differ only in where a null is.
    """
    parts = [x for r in ranks for x in (col(r).isNull(), F.coalesce(col(r).cast("string"), F.lit("")))]
    known = col(ranks[0]).isNotNull()
    above = F.coalesce(*(col(r).cast("string") for r in ranks[1:])).isNotNull()
    return F.when(known & above, F.xxhash64(*parts))


@operator("postprocessing", keyed=False)
def species_id(df: DataFrame, ranks: list[str] | None = None, output: str = "species_id", dense: bool = False) -> DataFrame:
    """A taxon id per row; ``dense`` numbers the distinct tuples from 0 in their order instead.

    Dense numbers need a global order of the distinct tuples only; a null-safe join brings them back.
    """
    ranks = ranks or RANKS
    if not dense:
        return df.withColumn(output, taxon_key(ranks))
    keyed = df.withColumn("__key", taxon_key(ranks))
    distinct = keyed.where(F.col("__key").isNotNull()).select("__key", *(col(r) for r in ranks)).dropDuplicates(["__key"])
    numbers = distinct.select("__key", (F.dense_rank().over(Window.orderBy(*(F.asc_nulls_first(f"`{r}`") for r in ranks))) - 1).cast("bigint").alias(output))
    return keyed.join(numbers, "__key", "left").drop("__key")


@operator("postprocessing")
def lowerbound(df: DataFrame, key: str, limit: int, flag: bool = True, dropna: bool = False) -> DataFrame:
    """Flag or keep taxa with at least ``limit`` rows; rows without a taxon are null, or stay unless ``dropna``.

    Counts are a partial aggregate joined back, so one taxon's rows never meet in a task.
    """
    counts = df.where(col(key).isNotNull()).groupBy(col(key).alias("__taxon")).agg(F.count("*").alias("__n"))
    if flag:
        out = df.join(counts, col(key) == F.col("__taxon"), "left")
        return out.withColumn(f"flag_taxasubset_isabove_{limit}", F.when(col(key).isNotNull(), F.col("__n") >= limit)).drop("__taxon", "__n")
    kept = df.join(counts.where(F.col("__n") >= limit), col(key) == F.col("__taxon"), "left_semi")
    return kept if dropna else kept.unionByName(df.where(col(key).isNull()))


def fair_order(df: DataFrame, key: str, cell: Column, order: list[Column]) -> DataFrame:
    """``__turn``: the row's place within its taxon's cell; taking turns in this order is max–min fair."""
    return df.withColumn("__cell", cell).withColumn("__turn", F.row_number().over(Window.partitionBy(col(key), "__cell").orderBy(*order)))


def draw_cells(pdf: pd.DataFrame, limit: int, seed: int, ring) -> pd.DataFrame:
    """One taxon's cells (columns cell_0.., n) thinned to ``limit`` finest cells.

    From the coarsest resolution on, cells are drawn in proportion to their area
    (equal here, so by chance among those left), each excluding its neighbours;
    a drawn cell is represented by one finest cell, by chance in proportion to
    its rows.  At the finest resolution neighbours are no longer excluded.
    """
    levels = [c for c in pdf.columns if c.startswith("cell_")]
    rng = np.random.default_rng([seed, abs(int(pdf["taxon_hash"].iloc[0])) % (1 << 32)])
    chosen: list[int] = []
    for level, name in enumerate(levels):
        last = level == len(levels) - 1
        cells = pdf[name].to_numpy()
        taken = np.isin(np.arange(len(pdf)), chosen)
        closed = set(cells[taken].tolist())
        if not last:
            closed |= {n for c in list(closed) for n in ring(int(c), level)}
        left = list(dict.fromkeys(c for c in cells.tolist() if c not in closed))
        if len(chosen) + len(left) <= limit and not last:
            picks = left
        else:
            picks = [left[i] for i in rng.permutation(len(left))]
        for c in picks:
            if len(chosen) >= limit:
                break
            if c in closed:
                continue
            rows = np.flatnonzero(cells == c)
            weight = pdf["n"].to_numpy()[rows].astype(float)
            chosen.append(int(rng.choice(rows, p=weight / weight.sum())))
            closed.add(c)
            if not last:
                closed |= set(ring(int(c), level))
        if len(chosen) >= limit:
            break
    return pdf.iloc[chosen][["taxon_hash", levels[-1]]].rename(columns={levels[-1]: "cell"})


@operator("postprocessing")
def upperbound(
    df: DataFrame,
    key: str,
    limit: int,
    latkey: str = "latitude",
    lonkey: str = "longitude",
    row_id: str = "row_id",
    resolution: int = 8,
    seed: int = 0,
    grid: Grid | None = None,
) -> DataFrame:
    """Taxa with ``limit`` rows or more are sampled to ``limit``, spread over grid cells; others stay whole.

    Taxa with more cells than ``limit`` first draw their cells from aggregated
    counts (never from rows); then every taxon takes rows in turns over its
    cells.  Order comes from a hash of ``row_id`` under a seed.  The per-cell
    counting and the pick by turns are windows whose limit Spark pushes below
    the shuffle, so a large taxon sends ``limit`` rows per task.
    """
    grid = grid or EqualAreaGrid()
    lat, lon = col(latkey).try_cast("double"), col(lonkey).try_cast("double")
    taxon = F.xxhash64(col(key))
    hashed = F.xxhash64(F.lit(seed), col(row_id))
    counts = df.where(col(key).isNotNull()).groupBy(taxon.alias("__t")).agg(F.count("*").alias("__n"))
    large = counts.where(F.col("__n") >= limit).select("__t")
    named = df.withColumn("__t", taxon)
    rest = named.join(large, "__t", "left_anti")
    sampled = named.join(large, "__t", "left_semi").withColumn("__c", grid.cell(lat, lon, resolution)).withColumn("__h", hashed)
    cells = sampled.groupBy("__t", "__c", *(grid.cell(lat, lon, r).alias(f"cell_{r}") for r in range(resolution))).agg(F.count("*").alias("n"))
    per_taxon = cells.groupBy("__t").agg(F.countDistinct("__c").alias("__m"))
    wide = cells.join(per_taxon.where(F.col("__m") > limit), "__t").select(
        F.col("__t").alias("taxon_hash"), *(F.col(f"cell_{r}") for r in range(resolution)), F.col("__c").alias(f"cell_{resolution}"), "n"
    )
    wide = wide.where(F.col(f"cell_{resolution}").isNotNull())
    ring = grid.ring

    def draw(pdf: pd.DataFrame) -> pd.DataFrame:
        return draw_cells(pdf.sort_values(list(pdf.columns)).reset_index(drop=True), limit, seed, ring)

    drawn = wide.groupBy("taxon_hash").applyInPandas(draw, "taxon_hash bigint, cell bigint").withColumn("__drawn", F.lit(0))
    ranked = sampled.join(drawn, (F.col("__t") == F.col("taxon_hash")) & F.col("__c").eqNullSafe(F.col("cell")), "left").drop("taxon_hash", "cell")
    ranked = ranked.withColumn("__turn", F.row_number().over(Window.partitionBy("__t", "__c").orderBy("__h"))).where(F.col("__turn") <= limit)
    # drawn cells take the first turns, then rows by turn and hash
    order = Window.partitionBy("__t").orderBy(F.coalesce(F.when(F.col("__turn") == 1, F.col("__drawn")), F.lit(1)), "__turn", F.xxhash64(F.lit(seed), F.col("__c")), "__h")
    picked = ranked.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= limit)
    return picked.select(*(col(c) for c in df.columns)).unionByName(rest.select(*(col(c) for c in df.columns)))


@operator("postprocessing")
def evenquota(df: DataFrame, key: str, cell: str, limit: int, order_key: str) -> DataFrame:
    """Deterministic quota: every taxon keeps ``limit`` rows, taken in turns over its cells by ``order_key``."""
    turns = fair_order(df, key, col(cell), [col(order_key)]).where(F.col("__turn") <= limit)
    rank = F.row_number().over(Window.partitionBy(col(key)).orderBy("__turn", "__cell", col(order_key)))
    return turns.withColumn("__rank", rank).where(F.col("__rank") <= limit).drop("__cell", "__turn", "__rank")


@operator("postprocessing")
def taxasubset(df: DataFrame, key: str, lower: int = 0, upper: int = 0, dropna: bool = False, **sampling) -> DataFrame:
    """Lower bound, then upper bound; a bound of 0 or less is off."""
    if lower > 0:
        df = lowerbound(df, key, lower, flag=False, dropna=dropna)
    return upperbound(df, key, upper, **sampling) if upper > 0 else df


def sampling_steps(df: DataFrame, key: str, cell: str) -> DataFrame:
    """Rows and cells per taxon, the log that stands in for sampling maps."""
    return df.groupBy(col(key)).agg(F.count("*").alias("n_rows"), F.countDistinct(col(cell)).alias("n_cells"))
