"""Operator 1: secret scans (DataFrame functions only).

Base rules find assignments, access keys and long hexadecimal runs.  Two
character Markov models, one of random strings and one of ordinary
identifiers, then score every other long token by its log-likelihood ratio;
tokens above the threshold are added as spans of kind ``markov``.  Both models
are trained from labelled samples.

Positions are code points, ends exclusive; a span is a whole match.  A null or
empty text has no spans.  Rows are independent; ids may repeat or be null, ties
do not arise, and an empty table gives an empty one (the models then learn from
the fixed samples alone).  Very long texts are scanned whole.  Other columns
keep their names; in :func:`redact` they travel in a struct and cannot clash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The base patterns.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_VALUE = 12
KINDS = ("assign", "access", "hex", "markov")

#: Tokens that the models score.
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}(?![A-Za-z0-9+/_-])"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-"
REDACTED = "[SECRET]"
#: Log-likelihood ratio above which a token is taken for a random string.
THRESHOLD = 10.0

#: Words of ordinary identifiers, the labelled sample that every model learns from.
ORDINARY = """
account action address amount answer application array attribute author average balance before begin between binary block
body boolean buffer button cache calendar callback category change channel character check child class clear client clock
close cluster code collection color column command comment commit common compare component compute condition config
connection constant container content context control convert copy count create current cursor customer data database date
decode default delete delta description design detail device dictionary directory display distance document domain double
driver duration dynamic edge element empty enable encode entity entry error event example exception execute export extend
external factory field file filter find first format forward frame function general generate global graph group handler
header height history identifier image import index information initial input insert instance integer interface internal
interval invalid item iterator join key label language last layer length level library line link list load local location
logger manager mapping margin master match matrix maximum measure memory message method minimum model module monitor
name network node normal notify number object offset open operation option order output owner package page parameter parent
parse password path pattern payload percent period pixel place player plugin pointer policy pool position prefix previous
print priority private process product profile program project property protocol provider public quality quantity query
queue quick random range rate reader record reference region register release remote remove render report request reset
resource response result return role root route rule runner sample scale schema scope screen search section select send
sequence server service session setting shape shared signal simple single size socket sort source space start state static
status step stop storage store stream string style submit subject suffix switch symbol system table target task template
term text thread time title toggle token total track transfer tree trigger type unit update upload user util valid value
variable vector version view visible visit wait watch weight width widget window wizard word worker wrapper write xml year
yield zero zone zoom
""".split()


def _matches(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """Spans of all leftmost non-overlapping matches, as array<struct<s,k,e,w>>."""
    span = "array<struct<s:int,k:int,e:int,w:string>>"
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    walked = F.aggregate(
        F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.struct(F.length(g).alias("g"), h.alias("h"))),
        F.struct(F.lit(0).alias("at"), F.array().cast(span).alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["g"] + F.length(x["h"])).alias("at"),
            F.concat(
                acc["out"],
                F.array(
                    F.struct(
                        (acc["at"] + x["g"]).alias("s"),
                        F.lit(kind).alias("k"),
                        (acc["at"] + x["g"] + F.length(x["h"])).alias("e"),
                        x["h"].alias("w"),
                    )
                ),
            ).alias("out"),
        ),
    )["out"]
    spans = F.filter(walked, keep) if keep else walked
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(span))


@dataclass(frozen=True)
class MarkovModel:
    """Log-likelihood ratios of character pairs, random over ordinary; bounded by the alphabet."""

    ratios: tuple[float, ...]
    threshold: float

    def score(self, token: Column) -> Column:
        size = len(ALPHABET) + 1
        table = F.split(F.lit(",".join(f"{r:.4f}" for r in self.ratios)), ",").cast("array<double>")
        place = lambda i: F.instr(F.lit(ALPHABET), F.substring(token, i, F.lit(1)))
        return F.aggregate(
            F.sequence(F.lit(1), F.greatest(F.length(token) - 1, F.lit(1))),
            F.lit(0.0),
            lambda acc, i: acc + F.get(table, place(i) * size + place(i + 1)),
        )


def train(samples: DataFrame, threshold: float = THRESHOLD) -> MarkovModel:
    """Fit both models from ``text string, label int`` (1: random, 0: ordinary).

    Pairs are counted by Spark; at most two counts per character pair reach the driver.
    """
    pairs = samples.where(F.length("text") > 1).select(
        "label",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.length("text") - 1),
                lambda i: F.instr(F.lit(ALPHABET), F.substring(F.col("text"), i, F.lit(1))) * (len(ALPHABET) + 1)
                + F.instr(F.lit(ALPHABET), F.substring(F.col("text"), i + 1, F.lit(1))),
            )
        ).alias("pair"),
    )
    size = len(ALPHABET) + 1
    count = {0: [1.0] * size * size, 1: [1.0] * size * size}
    for label, pair, n in pairs.groupBy("label", "pair").count().collect():
        count[label][pair] += n
    log = {
        label: [math.log(c[i] / sum(c[i - i % size : i - i % size + size])) for i in range(size * size)]
        for label, c in count.items()
    }
    return MarkovModel(tuple(r - o for r, o in zip(log[1], log[0], strict=True)), threshold)


def labelled_samples(
    spark: SparkSession, documents: DataFrame, rows: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``text, label``: random strings (1) and ordinary identifiers (0).

    Both sides have fixed samples, from a seeded rule and from a listed
    vocabulary, and labelled ones from at most ``rows`` documents: strings that
    the base rules find are random, the other words ordinary, alone and joined
    with their neighbours in snake and camel case, and in capitals; words with digits have no
    label.  The documents are those of the least hash of id and text in the
    whole table, so the same table gives the same models however it is stored.
    """
    listed = [ORDINARY[i] + j + x for i in range(len(ORDINARY)) for k in (1, 7, 31) for y in [ORDINARY[(i + k) % len(ORDINARY)]] for j, x in (("_", y), ("", y.capitalize()), ("-", y))]
    listed += [x.replace("-", "_").upper() for x in listed]
    fixed = spark.range(1).select(F.explode(F.split(F.lit(" ".join(listed)), " ")).alias("text"), F.lit(0).alias("label"))
    digest = F.sha2(F.concat(F.lit("sample-"), F.col("id").cast("string")), 256)
    random = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, F.substring(digest, 1, 40))
        .when(F.col("id") % 3 == 1, F.substring(F.base64(F.unhex(digest)), 1, 40))
        .otherwise(F.translate(F.substring(F.base64(F.unhex(digest)), 1, 32), "+/", "xY"))
        .alias("text"),
        F.lit(1).alias("label"),
    )
    named = documents.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    hashed = named.select(F.xxhash64("id", "text").alias("h"), "text")
    # one number reaches the driver; texts are not sorted
    least = hashed.select("h").orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    chosen = hashed.where(F.col("h") <= F.lit(least).cast("bigint")).dropDuplicates(["h"]).select("text")
    found = F.concat(
        F.filter(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(1)), lambda x: F.length(x) >= ASSIGN_VALUE),
        F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all("text", F.lit(HEX), F.lit(0)),
    )
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), HEX, " ")
    word = F.filter(F.split(plain, r"[^A-Za-z0-9]+"), lambda w: (F.length(w) >= 3) & ~w.rlike("[0-9]"))
    parts = chosen.select(found.alias("found"), word.alias("w"))
    joined = F.zip_with(
        "w", F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))), lambda a, b: F.concat(a, F.lit("_"), F.coalesce(b, F.lit("id")), F.initcap(F.coalesce(b, F.lit("id"))), a)
    )
    labelled = parts.select(
        F.explode(
            F.concat(
                F.transform("found", lambda x: F.struct(x.alias("text"), F.lit(1).alias("label"))),
                F.transform(F.concat("w", joined, F.transform("w", F.upper)), lambda x: F.struct(x.alias("text"), F.lit(0).alias("label"))),
            )
        ).alias("x")
    ).select("x.text", "x.label")
    return random.unionByName(labelled).unionByName(fixed)


def _with_spans(staged: DataFrame, model: MarkovModel) -> DataFrame:
    """``staged`` (a column ``text`` without nulls) with spans as array<struct<s,k,e>> by start, then kind."""
    text, rest = F.col("text"), staged.columns
    long_enough = lambda x: F.length(F.regexp_extract(x["w"], ASSIGN, 1)) >= ASSIGN_VALUE
    random = lambda x: x["w"].rlike("[A-Za-z]") & (model.score(x["w"]) > model.threshold)
    found = staged.select(
        *rest,
        F.concat(_matches(text, ASSIGN, 0, long_enough), _matches(text, ACCESS, 1), _matches(text, HEX, 2)).alias("base"),
        _matches(text, TOKEN, 3, random).alias("scored"),
    )
    apart = lambda x: ~F.exists("base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
    spans = F.sort_array(F.concat("base", F.filter("scored", apart)))
    plain = F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e")))
    return found.select(*rest, plain.alias("spans"))


def scan(df: DataFrame, model: MarkovModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text, spans``: spans as array<struct<s,k,e>> by start, then kind."""
    staged = df.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return _with_spans(staged, model).withColumnRenamed("id", id_col)


def redact(df: DataFrame, model: MarkovModel, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``df`` with every secret replaced by ``[SECRET]``; a length column, if there is one, follows."""
    staged = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    done = _with_spans(staged, model).select("row", F.when(F.size("spans") > 0, redacted(F.col("text"), F.col("spans"))).alias("clean"))

    def column(c: str) -> Column:
        if c == text_col:
            return F.coalesce("clean", f"row.`{c}`").alias(c)
        if c == length_col:
            return F.coalesce(F.length("clean").cast(df.schema[c].dataType), f"row.`{c}`").alias(c)
        return F.col(f"row.`{c}`").alias(c)

    return done.select(*map(column, df.columns))


def _kind(x: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, KINDS)), x["k"] + 1)


def digest(spans: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans as text."""
    joined = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", _kind(x), x["s"], x["e"])), ",")
    count = lambda k: F.size(F.filter("spans", lambda x: x["k"] == k)).cast("long")
    return spans.select(
        id_col,
        *(count(k).alias(f"n_{KINDS[k]}") for k in range(4)),
        F.sha2(joined(F.filter("spans", lambda x: x["k"] < 3)), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with every maximal run of overlapping spans replaced by ``[SECRET]``."""
    walked = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda acc, x: F.struct(
            F.greatest(acc["at"], x["e"]).alias("at"),
            F.when(
                x["s"] >= acc["at"],
                F.concat(acc["out"], F.array(F.substring(text, acc["at"] + 1, x["s"] - acc["at"]), F.lit(REDACTED))),
            )
            .otherwise(acc["out"])
            .alias("out"),
        ),
    )
    rest = F.substring(text, walked["at"] + 1, F.length(text))
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(F.array_join(walked["out"], ""), rest))
