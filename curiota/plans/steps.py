"""Operators as plans call them: whole-table steps, resources from outside, engine settings ignored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curiota.functions.naming import current
from curiota.operators import marine, quota, taxonomy
from curiota.operators.registry import REGISTRY, Operator
from curiota.sources.text import ADAPTERS

#: Settings of batching, workers, caches and remote calls: accepted, and without effect here.
ENGINE_ONLY = {
    "parallel", "cpu", "resume", "resume_parallel", "resume_mode", "overwrite", "overwrite_parallel", "skip_uniques_rebuild", "max_attempt",
    "pause_duration", "outputdir", "outputfile", "verbose", "indent", "filterfile", "split_type", "chunksize", "splitdir", "cleanup", "wormscall",
    "worms_dtypes", "inplace", "store_time", "store_stats", "java_exception", "memory",
}

#: Settings that change results: where an operator has none of the name, only the value that it acts on is accepted.
FIXED = {"doublecheck": True, "check_ambiguity": False, "drop_empty": False, "format": None}

STEPS: dict[str, Operator] = {}


def step(name: str, kind: str, keyed: bool):
    def add(function):
        STEPS[name] = Operator(name, kind, function, keyed)
        return function

    return add


@step("format", "transformation", False)
def format_source(df: DataFrame, dataset_name: str) -> DataFrame:
    """The source adapter of a dataset."""
    if dataset_name not in ADAPTERS:
        raise KeyError(f"no source adapter {dataset_name}; known: {sorted(ADAPTERS)}")
    return ADAPTERS[dataset_name](df)


@step("createwormsfilters", "transformation", True)
def filters(df: DataFrame, key: str) -> DataFrame:
    """Candidate tables are part of harmonization's own lineage, so there is nothing to prepare."""
    return df


@step("isinworms", "transformation", True)
def harmonize(
    df: DataFrame,
    key: str,
    register="$register",
    rank_mapping: dict[str, str] | None = None,
    verbatim: list[str] | None = None,
    uncertainty_level: int = 1,
    fuzzy: bool = True,
    keep_fossil: bool = False,
    marine_only: bool = True,
    flag: bool = False,
    stdnan: bool = True,
    decisions="$decisions",
) -> DataFrame:
    ranks = {("class" if r == "cls" else r): current(df.columns, c) or c for r, c in (rank_mapping or {}).items() if r != "scientificname"}
    settings = taxonomy.Settings(fuzzy=fuzzy, uncertainty_level=uncertainty_level, keep_fossil=keep_fossil, marine_only=marine_only)
    return taxonomy.harmonize(
        df, current(df.columns, key), register, ranks or None, verbatim, settings, None if isinstance(decisions, str) else decisions, flag
    )


@step("resolvetaxamatch", "postprocessing", False)
def review(df: DataFrame, keys: list[str] | None = None, decisions="$decisions", review_level: int = 1, flag: bool = False) -> DataFrame:
    """Reviewed decisions, where there are any; without them the uncertain rows go as always."""
    if isinstance(decisions, str):
        return df if flag else df.where(F.col("classif_match_generatedby_isinworms") == "match")
    return taxonomy.resolvetaxamatch(df, keys or [], decisions, flag)


@step("marineloc", "selection", False)
def marine_rows(df: DataFrame, latkey: str, lonkey: str, world="$world", keep_mask: bool = False) -> DataFrame:
    return marine.marineloc(df, current(df.columns, latkey), current(df.columns, lonkey), world, keep_mask)


@step("taxasubset", "postprocessing", False)
def taxa(
    df: DataFrame,
    lowerbound: int = 0,
    upperbound: int = 0,
    specieskey: str | None = None,
    ranks: list[str] | None = None,
    flag: bool = False,
    dropna: bool = False,
    latkey: str = "decimalLatitude",
    lonkey: str = "decimalLongitude",
    row_id: str = "row_id",
    resolution: int = 8,
    seed: int = 0,
) -> DataFrame:
    """Quotas on a taxon column, or on the tuple of rank columns there are."""
    key = specieskey
    if key is None:
        found = [c for r in ranks or quota.RANKS if (c := current(df.columns, r))]
        df, key = quota.species_id(df, found), "species_id"
    if lowerbound > 0:
        df = quota.lowerbound(df, key, lowerbound, flag, dropna)
    if upperbound > 0:
        df = quota.upperbound(df, key, upperbound, current(df.columns, latkey), current(df.columns, lonkey), row_id, resolution, seed)
    return df


def known(name: str) -> Operator | None:
    """The operator that a plan means by a name."""
    return STEPS.get(name) or REGISTRY.get(name)
