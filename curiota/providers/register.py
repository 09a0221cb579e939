"""Name registers: where candidate taxa come from.

A provider answers two questions in batches: which records a list of names has,
and what record an accepted id has.  Network clients implement the protocol and
are called per partition with few partitions (a rate limit); a fixture reads a
table, and is what runs without a network.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The fields of a register record.
FIELDS = (
    "AphiaID bigint, scientificname string, genus string, family string, `order` string, class string, phylum string, kingdom string, "
    "match_type string, status string, valid_AphiaID bigint, isExtinct bigint, isMarine bigint, isBrackish bigint, rank string, authority string"
)
FIELD_NAMES = [f.split()[0].strip("`") for f in FIELDS.split(", ")]
BATCH = 50


class RegisterProvider(Protocol):
    def by_names(self, names: list[str]) -> list[list[dict]]: ...

    def by_ids(self, ids: list[int]) -> list[dict | None]: ...


class Unavailable(RuntimeError):
    """The register did not answer within the allowed attempts."""


def retried(call: Callable, attempts: int = 10, pause: float = 5.0) -> Callable:
    """A call repeated after a pause; gives up with :class:`Unavailable`."""

    def run(*args):
        for attempt in range(attempts):
            try:
                return call(*args)
            except (OSError, TimeoutError) as error:
                if attempt + 1 == attempts:
                    raise Unavailable(str(error)) from error
                time.sleep(pause)

    return run


def lookup_names(names: DataFrame, make: Callable[[], RegisterProvider], workers: int = 2) -> DataFrame:
    """``query, <record fields>``: every record of every distinct name; names without one have no row.

    ``make`` builds the client inside a task, so nothing but its code travels.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider = make()
        ask = retried(provider.by_names)
        for pdf in batches:
            queries = pdf["query"].tolist()
            for lo in range(0, len(queries), BATCH):
                part = queries[lo : lo + BATCH]
                rows = [{"query": q, **r} for q, found in zip(part, ask(part), strict=True) for r in found]
                yield pd.DataFrame(rows, columns=["query", *FIELD_NAMES], dtype=object)

    distinct = names.select("query").where(F.col("query").isNotNull()).distinct().repartition(workers)
    return distinct.mapInPandas(run, f"query string, {FIELDS}")


def lookup_ids(ids: DataFrame, make: Callable[[], RegisterProvider], workers: int = 2) -> DataFrame:
    """Records of accepted ids; an id without a record gets ``match_quarantine``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider = make()
        ask = retried(provider.by_ids)
        for pdf in batches:
            wanted = [int(i) for i in pdf["id"]]
            for lo in range(0, len(wanted), BATCH):
                part = wanted[lo : lo + BATCH]
                rows = [r if r else {"AphiaID": i, "match_type": "match_quarantine"} for i, r in zip(part, ask(part), strict=True)]
                yield pd.DataFrame(rows, columns=FIELD_NAMES, dtype=object)

    distinct = ids.select("id").where(F.col("id").isNotNull()).distinct().repartition(workers)
    return distinct.mapInPandas(run, FIELDS)


class TableRegister:
    """A register from rows held in memory: a fixture, and the shape of a client."""

    def __init__(self, records: list[dict]):
        self.by_name: dict[str, list[dict]] = {}
        self.by_id: dict[int, dict] = {}
        for r in records:
            row = {k: r.get(k) for k in FIELD_NAMES}
            self.by_name.setdefault(str(r.get("query") or r.get("scientificname")), []).append(row)
            if r.get("AphiaID") is not None:
                self.by_id[int(r["AphiaID"])] = row

    def by_names(self, names: list[str]) -> list[list[dict]]:
        return [self.by_name.get(n, []) for n in names]

    def by_ids(self, ids: list[int]) -> list[dict | None]:
        return [self.by_id.get(i) for i in ids]


def table_lookup(queries: DataFrame, register: DataFrame) -> DataFrame:
    """The same answers from a register kept as a table: one equality join, no Python."""
    names = queries.select("query").where(F.col("query").isNotNull()).distinct()
    wanted = [F.col(f"`{c}`") for c in FIELD_NAMES]
    return names.join(register.withColumnRenamed("group", "query") if "group" in register.columns else register, "query").select("query", *wanted)


RANK_TREE = "AphiaID bigint, rank string, scientificname string"


def flatten_tree(node: dict | None) -> list[dict]:
    """A nested classification ``{AphiaID, rank, scientificname, child}`` as a list from the top down."""
    out = []
    while node:
        out.append({"AphiaID": node.get("AphiaID"), "rank": node.get("rank"), "scientificname": node.get("scientificname")})
        node = node.get("child")
    return out


def classification_wide(trees: DataFrame, ranks: list[str], id_col: str = "AphiaID", tree_col: str = "tree") -> DataFrame:
    """``id`` and one ``<rank>_AphiaID`` column per rank from classifications in JSON.

    Depth is bounded by the rank system: 40 levels are read.
    """
    import json

    @F.pandas_udf(f"array<struct<{', '.join(x.replace(' ', ':', 1) for x in RANK_TREE.split(', '))}>>")
    def flat(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: flatten_tree(json.loads(t)) if t else None)

    nodes = trees.select(F.col(f"`{id_col}`").alias("id"), F.explode_outer(flat(F.col(f"`{tree_col}`"))).alias("n"))
    wide = nodes.groupBy("id").agg(*(F.max(F.when(F.lower("n.rank") == r, F.col("n.AphiaID"))).alias(f"{r}_AphiaID") for r in ranks))
    return wide.withColumnRenamed("id", id_col)
