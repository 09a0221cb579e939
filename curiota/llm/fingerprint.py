"""Operator 5: improbable-feature document fingerprints.

Every byte of a text ends a window of up to ``WIDTH`` bytes, which is a feature;
at the beginning of a text windows are as long as there are bytes, so texts of
all lengths have features of one family.  A window's entropy (collision entropy,
from the number of equal byte pairs inside) falls into a class, and classes are
ranked by how rare they are in the corpus, low-entropy classes last.  In every
stretch of ``SPAN`` places, those that reach over the ends of the text included,
the rarest feature, leftmost on ties, gains popularity; features that win
``SPAN / POPULAR`` stretches are selected, each once.  They go into a chain of
Bloom filters of ``BITS`` bits with at most ``FEATURES`` features each.  Likeness
is the bit overlap of filters between its chance level and its largest possible
value, each filter of the shorter chain against its best counterpart, weighted
by its set bits.

A null text counts as empty and has the empty fingerprint; every other text has
features.  Equal fingerprints have likeness 1, an empty one has likeness 0 to any
other.  Rows without an id come after all others; rows that repeat an id go by a
hash of the text, and rows alike in both are each other's next documents.  An
empty table gives an empty one.  Texts are ranked in blocks, whatever their
length.  Ids are integers; other columns are not read, so names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curiota.llm.arrow import map_columns

WIDTH, SPAN, POPULAR = 32, 16, 4
BITS, FEATURES, HASHES = 2048, 160, 5
#: Equal byte pairs of a window: more of them is less entropy.  Classes above LOW_ENTROPY rank last.
CLASSES = WIDTH * (WIDTH - 1) // 2 + 1
LOW_ENTROPY = 120
#: Bytes that are ranked at a time, bytes of texts of a range, and rows per range that are sampled for the ranges' bounds.
_BLOCK, RANGE_BYTES, SAMPLED = 1 << 21, 64 << 20, 32
_NEVER = 1023


def pair_classes(data: np.ndarray) -> np.ndarray:
    """Equal byte pairs in the window that ends at each byte, by a sliding count."""
    n = data.size
    ahead, behind = np.zeros(n, dtype=np.uint8), np.zeros(n, dtype=np.uint8)
    for lag in range(1, min(WIDTH, n)):
        same = (data[:-lag] == data[lag:]).view(np.uint8)
        ahead[:-lag] += same
        behind[lag:] += same
    # a window gains the pairs of the byte that enters and loses those of the byte that leaves
    steps = behind.astype(np.int64)
    steps[WIDTH:] -= ahead[: max(n - WIDTH, 0)]
    return np.cumsum(steps)


def rank_table(histogram: np.ndarray) -> np.ndarray:
    """Rank of each class: rarest first; low-entropy classes last of all, the least entropy at the end."""
    classes = np.arange(CLASSES)
    order = np.lexsort((classes, np.where(classes > LOW_ENTROPY, 0, histogram), classes > LOW_ENTROPY))
    ranks = np.empty(CLASSES, dtype=np.int64)
    ranks[order] = np.arange(CLASSES)
    return ranks


def selected(data: bytes, ranks: np.ndarray) -> list[int]:
    """Last bytes of the selected windows of a text."""
    raw = np.frombuffer(data, dtype=np.uint8)
    if raw.size <= _BLOCK:
        return _popular(ranks[pair_classes(raw)]) if raw.size else []
    out: list[int] = []
    # blocks overlap by a span on both sides, and keep what lies in their own part
    for lo in range(0, raw.size, _BLOCK):
        begin, end = max(0, lo - SPAN), min(raw.size, lo + _BLOCK + SPAN)
        before = max(0, begin - WIDTH + 1)
        rank = ranks[pair_classes(raw[before:end])[begin - before :]]
        out += (x + begin for x in _popular(rank) if lo <= x + begin < lo + _BLOCK)
    return out


def _popular(rank: np.ndarray) -> list[int]:
    """Places that are the least of at least a quarter of a stretch's worth of stretches."""
    n = rank.size
    best = np.full(n + 2 * SPAN - 2, _NEVER << 32, dtype=np.int64)
    best[SPAN - 1 : SPAN - 1 + n] = rank << 32 | np.arange(n)
    step = 1
    while step < SPAN:
        best = np.minimum(best[:-step], best[step:])
        step *= 2
    wins = np.bincount(best & 0xFFFFFFFF, minlength=n)
    return np.flatnonzero(wins >= SPAN // POPULAR).tolist()


def fingerprint(data: bytes, ranks: np.ndarray) -> str:
    """The chain of filters, as hexadecimal digits."""
    digest = xxhash.xxh3_128_digest
    features = dict.fromkeys([digest(data[max(0, p - WIDTH + 1) : p + 1]) for p in selected(data, ranks)])
    if not features:
        return ""
    halves = np.frombuffer(b"".join(features), dtype="<u8").reshape(-1, 2)
    chain = np.arange(len(features)) // FEATURES * BITS
    bits = np.zeros((len(features) + FEATURES - 1) // FEATURES * BITS, dtype=np.uint8)
    for i in range(HASHES):
        bits[chain + (halves[:, i % 2] >> np.uint64(11 * (i // 2)) & np.uint64(BITS - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes().hex()


def _filters(mark: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(mark), dtype=np.uint64).reshape(-1, BITS // 64)


def likeness(a: str, b: str) -> float:
    """Normalised bit overlap of two fingerprints, 0 to 1."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    x, y = sorted((_filters(a), _filters(b)), key=len)
    ones_y = np.bitwise_count(y).sum(axis=1, dtype=np.int64)
    total, weight = 0.0, 0
    for row in x:
        ones = int(np.bitwise_count(row).sum(dtype=np.int64))
        common = np.bitwise_count(y & row).sum(axis=1, dtype=np.int64)
        chance, most = ones * ones_y / BITS, np.minimum(ones, ones_y)
        total += ones * float(np.max((common - chance) / np.maximum(most - chance, 1e-9)).clip(0.0, 1.0))
        weight += ones
    return total / weight


def corpus_statistics(df: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int, int]:
    """Windows per entropy class over all texts, bytes and rows; the driver gets one number for each."""

    def make():
        def work(texts):
            seen = np.zeros(CLASSES + 2, dtype=np.int64)
            for text in texts:
                raw = np.frombuffer((text or "").encode("utf-8"), dtype=np.uint8)
                seen[CLASSES:] += raw.size, 1
                for lo in range(0, raw.size, _BLOCK):
                    before = max(0, lo - WIDTH + 1)
                    seen[:CLASSES] += np.bincount(pair_classes(raw[before : lo + _BLOCK])[lo - before :], minlength=CLASSES)
            found = np.flatnonzero(seen)
            return [found.tolist(), seen[found].tolist()]

        return work

    out = np.zeros(CLASSES + 2, dtype=np.int64)
    for row in map_columns(df, [text_col], make, "class int, n bigint").groupBy("class").agg(F.sum("n").alias("n")).collect():
        out[row["class"]] = row["n"]
    return out[:CLASSES], int(out[CLASSES]), int(out[CLASSES + 1])


class Ranges:
    """Ranges of (id, hash of the text), in ascending order."""

    def __init__(self, keys: np.ndarray, hashes: np.ndarray, parts: int):
        order = np.lexsort((hashes, keys))
        cuts = np.unique((np.arange(1, parts) * order.size // parts)) if order.size else np.empty(0, dtype=np.int64)
        self.keys, self.hashes = keys[order[cuts]], hashes[order[cuts]]

    def place(self, keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The range of each row: how many bounds are at or below it."""
        low, out = np.searchsorted(self.keys, keys, side="left"), np.searchsorted(self.keys, keys, side="right")
        for i in np.flatnonzero(low < out).tolist():  # the id is that of a bound
            out[i] = low[i] + np.searchsorted(self.hashes[low[i] : out[i]], hashes[i], side="right")
        return out


def _dealing(spark: SparkSession, parts: int) -> list[int]:
    """Numbers that Spark's hash deals to partitions 0, 1, ... of ``parts``."""
    found: dict[int, int] = {}
    size = 8 * parts + 64
    while len(found) < parts:
        tried = spark.range(size).select("id", F.pmod(F.hash("id"), F.lit(parts)).alias("p")).groupBy("p").agg(F.min("id").alias("id"))
        found = {r["p"]: r["id"] for r in tried.collect()}
        size *= 2
    return [found[p] for p in range(parts)]


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of the next text."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


_RESULT = (
    "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def against_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every text and its edited text, and compare with the next document.

    The next document is the one before in ascending order of id, and the
    largest after the smallest.  Documents are dealt by ranges of ids and text
    hashes, of about ``RANGE_BYTES`` each; a range also gets a copy of the first
    document of the range that follows it, so no task needs more than its range.
    """
    spark = df.sparkSession
    own = F.col(f"`{id_col}`").cast("bigint")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    docs = df.select(
        own.isNull().alias("none"), F.coalesce(own, F.lit(-(1 << 63)).cast("bigint")).alias("id"), F.xxhash64(text).alias("h"), text.alias("text")
    )
    histogram, size, rows = corpus_statistics(docs)
    ranks = rank_table(histogram)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    # a sample by hash, bounded by SAMPLED rows a range on average, reaches the driver
    every = max(1, rows // (SAMPLED * parts))
    sampled = docs.where(F.pmod(F.xxhash64("h", "id"), F.lit(every)) == 0).select("id", "h").toArrow()
    ranges = Ranges(sampled.column("id").to_numpy(), sampled.column("h").to_numpy(), parts)
    deal_as = np.array(_dealing(spark, parts), dtype=np.int64)

    def largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(ranges.place(ids, hashes).astype(np.int64)), *batch.columns], names=["part", "id", "h"])

    # the first document of each range reaches the driver: two numbers
    tops = docs.select("id", "h").mapInArrow(largest, "part bigint, id bigint, h bigint").groupBy("part").agg(F.max(F.struct("id", "h")).alias("top"))
    first = {r["part"]: (r["top"]["id"], r["top"]["h"]) for r in tops.collect()}
    order = sorted(first, reverse=True)
    # the range in front of each, around the end: it needs a copy of this range's first document
    copy_to = {first[p]: order[i - 1] for i, p in enumerate(order)}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            again = [i for i, x in enumerate(zip(ids.tolist(), hashes.tolist(), strict=True)) if x in copy_to]
            part = np.concatenate((ranges.place(ids, hashes), [copy_to[int(ids[i]), int(hashes[i])] for i in again])).astype(np.int64)
            extra = np.concatenate((np.zeros(ids.size), np.ones(len(again)))).astype(np.int32)
            both = [pa.concat_arrays([c, c.take(pa.array(again, type=pa.int64()))]) for c in batch.columns]
            yield pa.RecordBatch.from_arrays(
                [pa.array(deal_as[part]), pa.array(part), pa.array(extra), *both], names=["dealt", "part", "extra", "none", "id", "h", "text"]
            )

    kind = docs.schema["text"].dataType.simpleString()
    dealt = docs.mapInArrow(deal, f"dealt bigint, part bigint, extra int, none boolean, id bigint, h bigint, text {kind}").repartition(parts, "dealt")
    dealt = dealt.sortWithinPartitions("part", "extra", F.col("id").desc(), F.col("none"), F.col("h").desc()).drop("dealt", "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", *(c.split()[0] for c in _RESULT.split(", "))]
        held, out = None, []

        def mark(text: str) -> str:
            return fingerprint(text.encode("utf-8"), ranks)

        def flush() -> pa.RecordBatch:
            columns = [list(c) for c in zip(*out, strict=True)] if out else [[] for _ in names]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)], names=names)

        ended = None
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                some = batch.slice(lo, 128)
                for part, extra, none, key, text in zip(*(c.to_pylist() for c in some.columns), strict=True):
                    if ended == part:  # further copies of the range that follows
                        continue
                    own = mark(text)
                    if held is not None and held[0] == part:
                        _, k, t, m = held
                        other = edited(t, text)
                        em = m if other == t else mark(other)
                        out.append((k, len(t), hashlib.sha256(other.encode("utf-8")).hexdigest(), m, em, likeness(m, em), likeness(m, own)))
                    held, ended = (part, None if none else key, text, own), part if extra else None
                yield flush()

    done = dealt.mapInArrow(run, f"id bigint, {_RESULT}")
    return done.withColumnRenamed("id", id_col)
