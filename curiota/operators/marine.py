"""Land and sea: raster lookup first, point in polygon only for coastal cells."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curiota.functions.geo import points_in_polygons
from curiota.functions.naming import col
from curiota.operators.registry import operator
from curiota.providers.landmask import COAST, LAND, SEA, LandMask


def _mask_value(df: DataFrame, world: LandMask, latkey: str, lonkey: str) -> DataFrame:
    """``marine_mask`` per row; rows without a place on the axes are land."""
    shared = df.sparkSession.sparkContext.broadcast(world.mask)

    @F.pandas_udf("int")
    def look(i: pd.Series, j: pd.Series) -> pd.Series:
        a, b = i.to_numpy(), j.to_numpy()
        found = shared.value[np.maximum(a, 0), np.maximum(b, 0)].astype(np.int32)
        return pd.Series(np.where((a < 0) | (b < 0), LAND, found))

    lat, lon = col(latkey).try_cast("double"), col(lonkey).try_cast("double")
    return df.withColumn("marine_mask", look(world.lat_index(lat), world.lon_index(lon)))


@operator("selection", keyed=False)
def island(df: DataFrame, latkey: str, lonkey: str, world: LandMask, output: str = "is_land") -> DataFrame:
    """``marine_mask`` and a flag for land; only coastal rows are tested against the polygons."""
    marked = _mask_value(df, world, latkey, lonkey)
    shared = df.sparkSession.sparkContext.broadcast(world.polygons)
    coast = marked.where(F.col("marine_mask") == COAST)
    schema = coast.withColumn(output, F.lit(False)).schema

    def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            lat = pd.to_numeric(pdf[latkey], errors="coerce").to_numpy(dtype=float)
            lon = pd.to_numeric(pdf[lonkey], errors="coerce").to_numpy(dtype=float)
            yield pdf.assign(**{output: points_in_polygons(lat, lon, shared.value)})

    plain = marked.where(F.col("marine_mask") != COAST).withColumn(output, F.col("marine_mask") == LAND)
    return plain.unionByName(coast.mapInPandas(test, schema))


def createmarinefilter(df: DataFrame, latkey: str, lonkey: str, idxkey: str, world: LandMask, controlkey: str | None = None) -> DataFrame:
    """Index, mask and coordinates (and a control value) of the rows at sea."""
    kept = island(df, latkey, lonkey, world).where(~F.col("is_land"))
    control = [col(controlkey).alias("control")] if controlkey else []
    return kept.select(col(idxkey).alias("index"), "marine_mask", col(latkey).alias("lat"), col(lonkey).alias("lon"), *control)


def filtermarinelocations(df: DataFrame, kept: DataFrame, idxkey: str, controlkey: str | None = None, keep_mask: bool = False) -> DataFrame:
    """Rows whose index is in the filter; a control value that differs is an error."""
    names = [F.col("index").alias("__index"), F.col("marine_mask").alias("__mask")]
    if controlkey:
        names.append(F.col("control").alias("__control"))
    joined = df.join(kept.select(*names), col(idxkey) == F.col("__index"))
    if controlkey:
        same = col(controlkey).eqNullSafe(F.col("__control"))
        joined = joined.where(F.when(same, F.lit(True)).otherwise(F.raise_error(F.lit("control value differs")).cast("boolean")))
    out = [F.col("__mask").alias("marine_mask")] if keep_mask else []
    return joined.select(*out, *(col(c) for c in df.columns))


@operator("selection", keyed=False)
def marineloc(df: DataFrame, latkey: str, lonkey: str, world: LandMask, keep_mask: bool = False) -> DataFrame:
    """Rows at sea; invalid and missing coordinates count as land and go."""
    out = island(df, latkey, lonkey, world).where(~F.col("is_land")).drop("is_land")
    return out if keep_mask else out.drop("marine_mask")


def land_sea_statistics(marked: DataFrame, by: Column | None = None) -> DataFrame:
    """Rows per mask class, at land and at sea, and the percentage that needed the polygons."""
    count = lambda c: F.count_if(c)
    mask = F.col("marine_mask")
    aggregates = [
        F.count("*").alias("n"),
        count(mask == LAND).alias("mask_land"),
        count(mask == SEA).alias("mask_sea"),
        count(mask == COAST).alias("mask_coast"),
        count(F.col("is_land")).alias("land"),
        count(~F.col("is_land")).alias("sea"),
        (100.0 * count(mask == COAST) / F.count("*")).alias("pct_coast"),
    ]
    return (marked.groupBy(by) if by is not None else marked.groupBy()).agg(*aggregates)
