"""Taxonomic harmonization: from raw names to decisions per distinct combination, joined back.

Register work goes over distinct names, resolution over distinct combinations
of ranks and verbatim columns; decisions come back by a null-safe key join.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curiota.functions.names import author_similarity, compare_ranks, name_score, name_variants, parse_authorship, years_apart
from curiota.functions.naming import col
from curiota.functions.durable import durable
from curiota.functions.nulls import is_missing
from curiota.functions.text import strip_quotes
from curiota.operators.registry import operator
from curiota.providers.register import FIELD_NAMES, table_lookup

#: Higher ranks from the bottom up, and the mismatches allowed by the number of one-sided ranks.
HIGHER = ["genus", "family", "order", "class", "phylum", "kingdom"]
ALLOWED = {0: 2, 1: 2, 2: 1, 3: 0, 4: 0, 5: 0, 6: -1}
#: Match types of candidates that stand for a species.
SPECIES_MATCHES = ("exact", "exact_subgenus", "phonetic", "near_1", "near_2", "near_3")

RANK_ORDER = [
    "forma", "variety", "subspecies", "species", "subgenus", "genus", "subtribe", "tribe", "subfamily", "family", "superfamily",
    "infraorder", "suborder", "order", "superorder", "infraclass", "subclass", "class", "superclass", "infraphylum", "subphylum",
    "phylum", "superphylum", "infrakingdom", "subkingdom", "kingdom", "superkingdom", "domain",
]
EQUIVALENT = {"division": "phylum", "subdivision": "subphylum", "form": "forma", "var": "variety", "subsp": "subspecies", "section": "subgenus"}


def subsetranks(rank: str, above: bool = True, inclusive: bool = False, equivalents: bool = True) -> list[str]:
    """Rank names above (or below) a rank, equivalents included."""
    at = RANK_ORDER.index(EQUIVALENT.get(rank.lower(), rank.lower()))
    part = RANK_ORDER[at + (not inclusive) :] if above else RANK_ORDER[: at + inclusive]
    return part + [e for e, r in EQUIVALENT.items() if equivalents and r in part]


def distinct_names(df: DataFrame, key: str) -> DataFrame:
    """``raw``: distinct non-missing names, outer quotes removed."""
    name = strip_quotes(col(key))
    return df.select(F.when(~is_missing(name, policy="contains_letters"), name).alias("raw")).where("raw is not null").distinct()


@operator("transformation")
def clean_names(df: DataFrame, key: str, min_length: int = 3, doublecheck: bool = True) -> DataFrame:
    """``raw, queries``: query strings for every distinct name of a column."""

    @F.pandas_udf("array<string>")
    def run(raw: pd.Series) -> pd.Series:
        return raw.map(lambda r: name_variants(r, min_length, doublecheck), na_action="ignore")

    return distinct_names(df, key).withColumn("queries", run("raw"))


def match_filter(queries: DataFrame, answers: DataFrame) -> DataFrame:
    """``raw, variant, <record>``: for every raw name the candidates of its first variant that has any.

    Records above species come last; a raw name without any is one ``nomatch`` row.
    """
    asked = queries.select("raw", F.posexplode_outer("queries").alias("variant", "query"))
    hits = asked.join(answers, "query", "left")
    above = F.col("match_type") == "match_abovespecies"
    usable = F.col("AphiaID").isNotNull() & F.coalesce(F.col("match_type").isin(*SPECIES_MATCHES), F.lit(True))
    rank = F.when(usable & ~F.coalesce(above, F.lit(False)), 0).when(F.col("AphiaID").isNotNull(), 1).when(F.col("match_type").isNotNull(), 2).otherwise(3)
    by = Window.partitionBy("raw")
    best = hits.withColumn("__level", rank).withColumn("__place", F.min(F.struct("__level", F.coalesce("variant", F.lit(0)))).over(by))
    kept = best.where((F.col("__level") == F.col("__place.__level")) & (F.coalesce("variant", F.lit(0)) == F.col("__place.col2")))
    record = [F.col(f"`{f}`") for f in FIELD_NAMES if f != "match_type"]
    return kept.select("raw", "variant", "query", *record, F.coalesce("match_type", F.lit("nomatch")).alias("match_type")).dropDuplicates(["raw", "AphiaID", "match_type"])


def accepted_filter(records: DataFrame, register: DataFrame, most: int = 1000) -> DataFrame:
    """``id, accepted_id, status, hops``: ``valid_AphiaID`` followed until it points to itself, however long the chain.

    Ids that come back to one seen before get status ``cycle``; a pointer without
    a record gets ``match_quarantine``.  Each round is one equality join of the
    ids that are still under way; two rounds at a time are written, and one
    count decides on further ones.  A chain of over ``most`` records is an error.
    """
    step = register.select(F.col("AphiaID").alias("__id"), F.col("valid_AphiaID").alias("__to")).dropDuplicates(["__id"])
    now = records.select(F.col("AphiaID").alias("id"), F.col("valid_AphiaID").alias("at")).where("id is not null").dropDuplicates(["id"])
    now = now.select("id", F.coalesce("at", "id").alias("at"), F.array("id").alias("path"), F.lit(None).cast("string").alias("status"))

    def moved(under_way: DataFrame) -> DataFrame:
        met = under_way.join(step, (F.col("at") == F.col("__id")) & F.col("status").isNull(), "left")
        here = F.col("at") == F.element_at("path", -1)
        status = (
            F.when(F.col("status").isNotNull(), F.col("status"))
            .when(here | (F.col("__to") == F.col("at")), F.lit("accepted"))
            .when(F.array_contains("path", F.col("at")), F.lit("cycle"))
            .when(F.col("__id").isNull(), F.lit("match_quarantine"))
        )
        return met.select(
            "id",
            F.when(status.isNull(), F.coalesce("__to", "at")).otherwise(F.col("at")).alias("at"),
            F.when(status.isNull(), F.concat("path", F.array("at"))).otherwise(F.col("path")).alias("path"),
            status.alias("status"),
        )

    done = []
    for _ in range(0, most, 2):
        now = durable(moved(moved(now)))
        done.append(now.where("status IS NOT NULL"))
        now = now.where("status IS NULL")
        if now.isEmpty():
            break
    else:
        raise RuntimeError(f"a chain of over {most} records")
    ended = reduce(DataFrame.unionAll, done)
    return ended.select("id", F.when(F.col("status") == "accepted", F.col("at")).alias("accepted_id"), "status", (F.size("path") - 1).alias("hops"))


@dataclass(frozen=True)
class Settings:
    """What resolution may be told."""

    ranks: tuple[str, ...] = tuple(HIGHER)
    #: candidates whose name ratio is that near to the best one's stay in question
    name_tolerance: float = 1e-2
    fuzzy: bool = True
    rank_ratio: float = 0.7
    name_ratio: float = 0.8
    author_ratio: float = 0.7
    year_tolerance: int = 2
    allowed: dict[int, int] = field(default_factory=lambda: dict(ALLOWED))
    uncertainty_level: int = 1
    keep_fossil: bool = False
    marine_only: bool = True


@dataclass
class Decision:
    decision: str
    reason: str
    candidate: int | None = None
    issues: list[str] = field(default_factory=list)


def _by_authorship(pool: list[int], candidates: list[dict], verbatims: list[str | None], prefix: str, s: Settings) -> Decision | None:
    """Narrow a pool by authorship; None if no verbatim column tells anything."""
    issues = []
    for verbatim in verbatims:
        if verbatim is None:
            continue
        given = parse_authorship(verbatim)
        if given is None:
            issues.append("AUTHORSHIP_PARSE_FAILED")
            continue
        known = {i: parse_authorship(candidates[i].get("authority")) for i in pool}
        if sum(bool(re.search(r"sensu.*sensu", str(candidates[i].get("authority")).lower())) for i in pool):
            issues.append("AUTHORSHIP_MULTIPLE_SENSU")
            continue
        scores = {i: author_similarity(given, a) for i, a in known.items() if a}
        apart = {i: years_apart(given, a) for i, a in known.items() if a}
        good = [i for i in scores if (scores[i] is None or scores[i] >= s.author_ratio) and (apart[i] is None or apart[i] <= s.year_tolerance) and (scores[i] is not None or apart[i] is not None)]
        if not good:
            reason = "noMatchIsMore" if given.extra else "noMatch"
            unsure = given.extra and s.uncertainty_level >= 2
            return Decision("uncertain" if unsure else "nomatch", f"{prefix}_authorship_{reason}", None, issues)
        if len(good) == 1:
            return Decision("match", f"{prefix}_authorship_singleMatch", good[0], issues)
        top = max(scores[i] or 0.0 for i in good)
        best = [i for i in good if (scores[i] or 0.0) >= top - 1e-2]
        if len(best) == 1:
            return Decision("match", f"{prefix}_authorship_bestAuthorMatch", best[0], issues)
        dated = [i for i in best if apart[i] is not None]
        if dated:
            near = min(apart[i] for i in dated)
            closest_ones = [i for i in dated if apart[i] == near]
            if len(closest_ones) == 1:
                return Decision("match", f"{prefix}_authorship_bestDateMatch", closest_ones[0], issues)
            best = closest_ones
        agree = [i for i in best if known[i].sensu == given.sensu]
        if len(agree) == 1:
            return Decision("match", f"{prefix}_authorship_noSensuConflict", agree[0], issues)
    return None


def _structure(name: str | None) -> str | None:
    if name and re.fullmatch(r"[A-Z][a-z-]+ [a-z-]+( [a-z-]+)?", name):
        return "plain"
    if name and re.fullmatch(r"[A-Z][a-z-]+ \([A-Z][a-z-]+\) [a-z-]+( [a-z-]+)?", name):
        return "subgenus"
    return None


def _choose(raw: str | None, given: dict, verbatims: list, candidates: list[dict], s: Settings) -> Decision:
    kinds = [c.get("match_type") for c in candidates]
    if not candidates or all(k in (None, "nomatch") for k in kinds):
        return Decision("nomatch", "worms_taxonNoMatch")
    if all(k in ("nomatch", "match_abovespecies") for k in kinds):
        return Decision("nomatch", "worms_taxonNoSpecies")
    if all(k in ("match_quarantine", "match_deleted", "nomatch") for k in kinds):
        return Decision("nomatch", "worms_taxonQuarantineDeleted")
    usable = [i for i, k in enumerate(kinds) if k in SPECIES_MATCHES]
    compared = {i: compare_ranks(given, candidates[i], list(s.ranks), s.fuzzy, s.rank_ratio) for i in usable}
    passing = [i for i in usable if compared[i][0] <= s.allowed.get(compared[i][1], -1)]
    if passing:
        scores = {i: name_score(candidates[i].get("scientificname"), raw) for i in passing}
        if len(passing) > 1 and len({candidates[i].get("scientificname") for i in passing}) > 1:
            # candidates that resemble the name come first; equal ones keep their order
            passing = sorted(passing, key=lambda i: (scores[i][1] < s.name_ratio, -scores[i][0], -scores[i][1]))
        seen, unique = set(), []
        for i in passing:
            c = candidates[i]
            mark = (*(c.get(r) for r in s.ranks), c.get("authority"), c.get("valid_AphiaID"))
            if mark not in seen:
                seen.add(mark)
                unique.append(i)
        passing = unique
        if len(passing) == 1:
            return Decision("match", "classification_singleMatch", passing[0])
        if len({candidates[i].get("valid_AphiaID") for i in passing}) == 1:
            return Decision("match", "classification_singleAphiaID", passing[0])
        by_author = _by_authorship(passing, candidates, verbatims, "classification", s)
        if by_author:
            return by_author
        level = min(sum(compared[i]) for i in passing)
        best = [i for i in passing if sum(compared[i]) == level]
        fewest = min(compared[i][0] for i in best)
        best = [i for i in best if compared[i][0] == fewest]
        if len(best) == 1:
            return Decision("match", "classification_bestMatch", best[0])
        shapes = {_structure(candidates[i].get("scientificname")) for i in best}
        if len(shapes) == 1 and None not in shapes:
            hits = max(scores[i][0] for i in best)
            first = [i for i in best if scores[i][0] == hits]
            high = max(scores[i][1] for i in first)
            first = [i for i in first if high - scores[i][1] < s.name_tolerance]
            if len(first) == 1:
                return Decision("match", "classification_bestSpeciesName", first[0])
        alike = {(*(candidates[i].get(r) for r in HIGHER), candidates[i].get("status")) for i in best}
        if len(alike) == 1 and candidates[best[0]].get("status") == "accepted":
            return Decision("uncertain", "classification_allAccepted")
        return Decision("uncertain", "classification_undecided")
    kingdom = given.get("kingdom")
    same = [i for i in usable if kingdom is None or candidates[i].get("kingdom") is None or candidates[i]["kingdom"].lower() == kingdom.lower()]
    if not same:
        return Decision("nomatch", "noclassification_kingdomNoMatch")
    by_author = _by_authorship(same, candidates, verbatims, "noclassification", s)
    return by_author or Decision("uncertain", "noclassification_kingdomMatch")


def resolve_match(raw: str | None, given: dict, verbatims: list, candidates: list[dict], settings: Settings | None = None) -> Decision:
    """The decision for one combination: register, classification, authorship, then habitat and fossils."""
    s = settings or Settings()
    if raw is None:
        return Decision("nomatch", "taxonNoSpecies")
    d = _choose(raw, given, verbatims, candidates, s)
    if d.decision == "nomatch":
        return d
    pool = [candidates[d.candidate]] if d.candidate is not None else [c for c in candidates if c.get("match_type") in SPECIES_MATCHES]
    if s.marine_only:
        wet = [(c.get("isMarine"), c.get("isBrackish")) for c in pool]
        if all(m == 0 and b == 0 for m, b in wet):
            return Decision("nomatch", d.reason + "_non_marine", None, d.issues)
        if d.decision == "match" and not any(1 in w for w in wet):
            d = Decision("uncertain", d.reason + "_marine_unsure", d.candidate, d.issues)
    if not s.keep_fossil and all(c.get("isExtinct") == 1 for c in pool):
        return Decision("nomatch", d.reason + "_fossil", None, d.issues)
    if d.decision == "match" and pool[0].get("status") == "cycle":
        return Decision("uncertain", d.reason, d.candidate, [*d.issues, "UNRESOLVED_TAXONOMIC_CYCLE"])
    return d


#: Combinations of one name that are decided together.
CHUNK = 256


def combination_key(columns: list[str]) -> Column:
    """A hash of a tuple in which null is a value."""
    return F.xxhash64(*(x for c in columns for x in (col(c).isNull(), F.coalesce(col(c).cast("string"), F.lit("")))))


def review_queue(decided: DataFrame, level: int = 1) -> DataFrame:
    """Combinations whose uncertain decision a reviewer may settle, by level 1 to 3."""
    reasons = ["noclassification_kingdomMatch", "classification_authorship_noMatchIsMore", "noclassification_authorship_noMatchIsMore"]
    base = F.regexp_replace("reason", "_(marine_unsure|userSelected)$", "")
    return decided.where((F.col("decision") == "uncertain") & base.isin(*reasons[:level]))


@operator("transformation", keyed=False, name="isinworms")
def harmonize(
    df: DataFrame,
    namekey: str,
    register: DataFrame,
    rankkeys: dict[str, str] | None = None,
    verbatimkeys: list[str] | None = None,
    settings: Settings | None = None,
    decisions: DataFrame | None = None,
    flag: bool = False,
    keep_uncertain: bool = False,
) -> DataFrame:
    """Match names and classifications to a register table and write the accepted taxon.

    Adds ``classif_match``, ``classif_matchtype``, ``AphiaID``, accepted ranks and
    ``issue_isinworms``; with ``flag=False`` rows without a match (and uncertain
    ones, unless kept) go.  ``decisions`` holds reviewed combinations
    (``key, decision, reason, AphiaID``), which take precedence.
    """
    s = settings or Settings()
    given = {r: k for r, k in (rankkeys or {r: r for r in s.ranks if r in df.columns}).items() if k in df.columns}
    verbatims = [v for v in (verbatimkeys or []) if v in df.columns]
    name = strip_quotes(col(namekey))
    tidy = lambda c: F.when(~is_missing(c, policy="contains_letters"), c)
    staged = df.withColumns({"__raw": tidy(name), **{f"__r_{r}": tidy(col(k)) for r, k in given.items()}, **{f"__v_{i}": tidy(col(v)) for i, v in enumerate(verbatims)}})
    parts = ["__raw", *(f"__r_{r}" for r in given), *(f"__v_{i}" for i in range(len(verbatims)))]
    keyed = staged.withColumn("__key", combination_key(parts))
    combos = keyed.select("__key", *parts).dropDuplicates(["__key"])
    queries = clean_names(combos, "__raw")
    answers = table_lookup(queries.select(F.explode("queries").alias("query")), register)
    matched = match_filter(queries, answers)
    fields = F.struct(*(F.col(f"`{f}`") for f in FIELD_NAMES))
    lists = matched.groupBy("raw").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("variant", F.lit(0)).alias("v"), F.coalesce("AphiaID", F.lit(0)).alias("a"), fields.alias("c")))).alias("cs"))
    lists = lists.select(F.col("raw").alias("__raw2"), F.transform("cs", lambda x: x["c"]).alias("candidates"))
    # a row for each name and at most CHUNK of its combinations: the candidates travel once for all of them
    place = F.row_number().over(Window.partitionBy("__raw").orderBy("__key"))
    told = F.struct("__key", *parts[1:])
    chunks = combos.withColumn("__chunk", F.floor((place - 1) / CHUNK)).groupBy("__raw", "__chunk").agg(F.collect_list(told).alias("combos"))
    joined = chunks.join(lists, F.col("__raw") == F.col("__raw2"), "left").select("__raw", "combos", "candidates")
    record = joined.schema["candidates"].dataType.elementType

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, asked, known = (batch.column(n) for n in ("__raw", "combos", "candidates"))
            for i in range(batch.num_rows):
                raw, told, pool = names[i].as_py(), asked[i].as_py(), known[i].values
                found = [{k: None if isinstance(v, float) and v != v else v for k, v in c.items()} for c in pool.to_pylist()] if pool is not None else []
                ds = [resolve_match(raw, {r: c[f"__r_{r}"] for r in given}, [c[f"__v_{j}"] for j in range(len(verbatims))], found, s) for c in told]
                at = pa.array([d.candidate for d in ds], pa.int32())
                columns = {
                    "__key": pa.array([c["__key"] for c in told], pa.int64()),
                    "decision": pa.array([d.decision for d in ds], pa.string()),
                    "reason": pa.array([d.reason for d in ds], pa.string()),
                    "issue": pa.array([";".join(d.issues) or None for d in ds], pa.string()),
                    "c": pool.take(at) if pool is not None else pa.nulls(len(ds), known.type.value_type),
                }
                yield pa.RecordBatch.from_pydict(columns)

    # what follows reads the decisions twice
    decided = durable(joined.mapInArrow(decide, f"__key bigint, decision string, reason string, issue string, c {record.simpleString()}"))
    if decisions is not None:
        own = decisions.select(F.col("key").alias("__key"), F.col("decision").alias("__d"), F.concat("reason", F.lit("_userSelected")).alias("__r"), F.col("AphiaID").alias("__a"))
        decided = decided.join(own, "__key", "left").select("__key", F.coalesce("__d", "decision").alias("decision"), F.coalesce("__r", "reason").alias("reason"), "issue", "c", "__a")
    else:
        decided = decided.withColumn("__a", F.lit(None).cast("bigint"))
    decided = decided.withColumn("__taxon", F.coalesce("__a", "c.AphiaID"))
    accepted = accepted_filter(decided.select(F.col("__taxon").alias("AphiaID"), F.coalesce("c.valid_AphiaID", "__taxon").alias("valid_AphiaID")), register)
    final = register.select(F.col("AphiaID").alias("accepted_id"), "scientificname", *(F.col(f"`{r}`") for r in HIGHER), "status", "rank").dropDuplicates(["accepted_id"]).toDF(
        "accepted_id", "acc_name", *(f"acc_{r}" for r in HIGHER), "acc_status", "acc_rank"
    )
    taxa = (
        decided.join(accepted.withColumnRenamed("status", "__chain"), F.col("__taxon") == F.col("id"), "left")
        .join(final, "accepted_id", "left")
        .select(
            "__key",
            F.when((F.col("decision") == "match") & F.col("__chain").isin("cycle", "match_quarantine"), "uncertain").otherwise(F.col("decision")).alias("classif_match_generatedby_isinworms"),
            F.col("reason").alias("classif_matchtype_generatedby_isinworms"),
            F.concat_ws(";", "issue", F.when(F.col("__chain") == "cycle", "UNRESOLVED_TAXONOMIC_CYCLE")).alias("issue_isinworms"),
            F.col("accepted_id").alias("AphiaID_generatedby_isinworms"),
            F.col("acc_name").alias("scientificname_generatedby_isinworms"),
            *(F.col(f"acc_{r}").alias(f"{r}_generatedby_isinworms") for r in HIGHER),
            F.upper("acc_rank").alias("rank_generatedby_isinworms"),
        )
    )
    out = keyed.join(taxa, "__key").drop("__key", *parts)
    if flag:
        return out
    kept = ["match", "uncertain"] if keep_uncertain else ["match"]
    return out.where(F.col("classif_match_generatedby_isinworms").isin(*kept))


@operator("postprocessing", keyed=False)
def resolvetaxamatch(df: DataFrame, keys: list[str], decisions: DataFrame, flag: bool = False) -> DataFrame:
    """Apply reviewed decisions (``key, decision, reason``) to the rows of their combination.

    Rows still without a match go unless flagged.
    """
    match, kind = "classif_match_generatedby_isinworms", "classif_matchtype_generatedby_isinworms"
    own = decisions.select(F.col("key").alias("__key"), F.col("decision").alias("__d"), F.concat("reason", F.lit("_userSelected")).alias("__r"))
    joined = df.withColumn("__key", combination_key(keys)).join(own, "__key", "left")
    out = joined.withColumn(match, F.coalesce("__d", match)).withColumn(kind, F.coalesce("__r", kind)).drop("__key", "__d", "__r")
    return out if flag else out.where(F.col(match) == "match")
