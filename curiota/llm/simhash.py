"""Operator 3: SimHash near-duplicates through deletion-variant signatures.

Fingerprints of 64 bits are cut into ``distance // 2 + 1`` segments, so among
fingerprints that differ in at most ``distance`` bits one segment differs in at
most one.  Every segment is indexed once per bit with that bit removed; equal
variants bring candidates together and each is verified on the whole
fingerprint.  Equal fingerprints are one class before anything is joined.

Within the fingerprints of one variant, links are found by growing groups from
a seed against the fingerprints not reached yet, and only the links of a
spanning forest leave the task: every link between different fingerprints is
kept as a connection, and pairs are never listed.  Components are closed by
alternating large-star and small-star rounds.

Words are runs of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return, with A-Z lower-cased.  A null text counts as empty;
texts without words have fingerprint zero and link like any other.  Rows that
repeat an id are one document.  Components are built on fingerprints, so rows
without an id connect like any other; they never name a component that has ids.
Ties in a bit (exactly half) give 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curiota.llm.arrow import ensure_checkpoint_dir, map_columns, released

#: Shingles whose bits are added up at a time.
_BLOCK = 1 << 15


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The unsigned 64-bit SimHash of a text."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends - 1)[min(shingle, len(words)) - 1 :].tolist()
    joined, digest = b" ".join(words), xxhash.xxh64_digest
    ones = np.zeros(64, dtype=np.int64)
    for lo in range(0, n, _BLOCK):
        raw = b"".join([digest(joined[s:e], 42) for s, e in zip(starts[lo : lo + _BLOCK], stops[lo : lo + _BLOCK], strict=True)])
        bits = np.unpackbits(np.frombuffer(raw, dtype=np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(df: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fp``: the fingerprint as a signed long."""

    def make():
        return lambda keys, texts: [keys, [_signed(fingerprint(t, shingle)) for t in texts]]

    kind = df.schema[id_col].dataType.simpleString()
    return map_columns(df.select(F.col(f"`{id_col}`").alias("id"), f"`{text_col}`"), ["id", text_col], make, f"id {kind}, fp bigint")


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def variants(classes: DataFrame, distance: int) -> DataFrame:
    """``key, fp``: one row per fingerprint, segment and removed bit."""
    segments = distance // 2 + 1
    edges = [64 * i // segments for i in range(segments + 1)]
    keys = []
    for s, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
        part = F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1 if hi - lo < 64 else -1))
        for bit in range(hi - lo):
            rest = part.bitwiseAND(F.lit(~(1 << bit)))
            # segment and bit in the upper part of the key where it fits, else mixed in
            tag = (s * 64 + bit) << 48
            keys.append(rest.bitwiseOR(F.lit(tag)) if hi - lo <= 48 else F.xxhash64(F.lit(s * 64 + bit), rest))
    return classes.select("fp", F.explode(F.array(*keys)).alias("key")).select("key", "fp")


def _forest(run: np.ndarray, distance: int) -> Iterator[tuple[int, np.ndarray]]:
    """Spanning links of one variant's fingerprints: (seed, linked fingerprints)."""
    left = run
    while left.size > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and left.size:
            x = frontier.pop()
            near = np.bitwise_count(left ^ x) <= distance
            if near.any():
                hit, left = left[near], left[~near]
                yield x, hit
                frontier.extend(hit)


def links(classes: DataFrame, distance: int) -> DataFrame:
    """``a, b``: verified links between different fingerprints that connect all linked ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def grown(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            cut = np.flatnonzero(np.diff(keys)) + 1
            starts, stops = np.concatenate(([0], cut)), np.concatenate((cut, [keys.size]))
            found = [np.empty((0, 2), dtype=np.uint64)]
            two = starts[stops - starts == 2]
            ok = np.bitwise_count(fps[two] ^ fps[two + 1]) <= distance
            found.append(np.stack((fps[two][ok], fps[two + 1][ok]), axis=1))
            many = np.flatnonzero(stops - starts > 2)
            for lo, hi in zip(starts[many], stops[many], strict=True):
                for x, hit in _forest(fps[lo:hi], distance):
                    found.append(np.stack((np.full(hit.size, x, dtype=np.uint64), hit), axis=1))
            pairs = np.concatenate(found)
            pairs.sort(axis=1)
            pairs = np.unique(pairs, axis=0) if pairs.size else pairs
            return pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0].view(np.int64)), pa.array(pairs[:, 1].view(np.int64))], names=["a", "b"]
            )

        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            fps = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if not keys.size:
                continue
            # a variant that may go on in the next batch waits
            last = int(np.searchsorted(keys, keys[-1], side="left"))
            if held and (last or keys[0] != held[-1][0][-1]):
                at = last if last else 0
                yield grown(np.concatenate([k for k, _ in held] + [keys[:at]]), np.concatenate([f for _, f in held] + [fps[:at]]))
                held = []
            elif last:
                yield grown(keys[:last], fps[:last])
            held.append((keys[last:], fps[last:]))
        if held:
            yield grown(np.concatenate([k for k, _ in held]), np.concatenate([f for _, f in held]))

    indexed = variants(classes, distance)
    dealt = indexed.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(released(run), "a bigint, b bigint").distinct()


def components(edges: DataFrame, rounds: int = 200) -> DataFrame:
    """``node, root``: the smallest node reachable, for every node that has an edge (u, v).

    Alternates large-star and small-star until nothing changes; rounds grow as
    the logarithm of the edges, and running out of them is an error.  Only a count
    and a checksum reach the driver; each round's edges go to the shared
    checkpoint folder, so a lost executor repeats one round at most.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    current = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct().checkpoint()
    mark = None
    for _ in range(rounds):
        both = current.union(current.select("v", "u")).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")
        )
        current = small.select("e.u", "e.v").where("u <> v").distinct().checkpoint()
        now = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return current.toDF("node", "root")
        mark = now
    raise RuntimeError(f"components are not closed after {rounds} rounds")


def _rooted(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``fp, root``: every fingerprint with the smallest one that ``edges`` (a, b) connect it to."""
    roots = components(edges.toDF("u", "v"))
    return nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    df: DataFrame, shingle: int = 3, distance: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, fingerprint, component_id`` for every row."""
    ensure_checkpoint_dir(df.sparkSession)
    prints = fingerprints(df, shingle, id_col, text_col).checkpoint()
    classes = prints.groupBy("fp").agg(F.min("id").alias("first_id"))
    # an id that stands for several fingerprints joins them
    several = prints.groupBy("id").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo <> hi").select("id", "lo")
    own = prints.join(several, "id").select(F.col("lo").alias("a"), F.col("fp").alias("b"))
    rooted = _rooted(classes, links(classes.select("fp"), distance).union(own)).join(classes, "fp")
    firsts = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labelled = rooted.join(firsts, "root").select(F.col("fp").alias("class_fp"), "component_id")
    return prints.join(labelled, F.col("fp") == F.col("class_fp")).select(
        F.col("id").alias(id_col), hexadecimal(F.col("fp")).alias("fingerprint"), "component_id"
    )


#: Minima of a text's five-word shingles; the first are in bands of ROWS, and two texts meet if a band is equal.
SIMILAR_SHINGLE, BANDS, ROWS, MINIMA = 5, 21, 3, 126
#: Minima that linked texts share: an estimated similarity of 0.7, nearly three deviations below 0.8.
LEAST_SHARED = 88
_FACTORS = np.random.default_rng(11).integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sketch(text: str | None) -> tuple[list[int], bytes]:
    """A key per band and a byte per minimum of the text's shingles; no keys for a text without words."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return [], b""
    n, digest, step = max(1, len(words) - SIMILAR_SHINGLE + 1), xxhash.xxh3_64_digest, _BLOCK // 16
    low = np.full(MINIMA, np.iinfo(np.uint64).max, dtype=np.uint64)
    for lo in range(0, n, step):
        raw = b"".join([digest(b" ".join(words[i : i + SIMILAR_SHINGLE])) for i in range(lo, min(n, lo + step))])
        low = np.minimum(low, (np.frombuffer(raw, dtype="<u8")[:, None] * _FACTORS).min(axis=0))
    keys = [_signed(xxhash.xxh3_64_intdigest(low[b * ROWS : (b + 1) * ROWS].tobytes(), b)) for b in range(BANDS)]
    return keys, (low >> np.uint64(24)).astype(np.uint8).tobytes()


def _alike(marks: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Spanning links of the sketches of one band: (seed, linked places)."""
    left = np.arange(len(marks))
    while left.size > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and left.size:
            x = frontier.pop()
            near = (marks[left] == marks[x]).sum(axis=1) >= LEAST_SHARED
            if near.any():
                hit, left = left[near], left[~near]
                yield x, hit
                frontier.extend(hit)


def similar_links(sketched: DataFrame) -> DataFrame:
    """``a, b``: links between fingerprints of texts alike in five-word shingles, from ``fp, keys, marks``.

    A row per band carries the whole sketch, so candidates are verified where they meet, and groups grow from a seed
    as in :func:`links`; pairs are never listed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def grown(fps: list[int], marks: list[bytes]) -> pa.RecordBatch:
            found = _alike(np.frombuffer(b"".join(marks), dtype=np.uint8).reshape(len(fps), -1))
            pairs = {(min(fps[x], fps[y]), max(fps[x], fps[y])) for x, hit in found for y in hit.tolist() if fps[x] != fps[y]}
            return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], type=pa.int64()) for i in (0, 1)], names=["a", "b"])

        key, fps, marks = None, [], []
        for batch in batches:
            for k, fp, mark in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != key:
                    if len(fps) > 1:
                        yield grown(fps, marks)
                    key, fps, marks = k, [], []
                fps.append(fp)
                marks.append(mark)
        if len(fps) > 1:
            yield grown(fps, marks)

    banded = sketched.distinct().select(F.explode("keys").alias("key"), "fp", "marks")
    dealt = banded.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(released(run), "a bigint, b bigint").distinct()


def drop_near_duplicates(
    df: DataFrame, shingle: int = 3, distance: int = 3, id_col: str = "doc_id", text_col: str = "text", similar: bool = False
) -> DataFrame:
    """One row of ``df``, with all its columns, of every component of texts.

    ``similar`` also connects texts whose five-word shingles are alike by 0.8, however far their fingerprints are.
    It is the row of the smallest id, nulls last, then of the smallest hash of its columns; rows that repeat an id
    with another text are documents of their own.
    """
    ensure_checkpoint_dir(df.sparkSession)
    kind = df.schema[id_col].dataType
    hashed = [F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()]
    key = {
        "__none": F.col(f"`{id_col}`").isNull(),
        "__own": F.coalesce(F.col(f"`{id_col}`"), F.lit("0").cast(kind)),
        "__hash": F.xxhash64(*hashed),
    }

    def make():
        def work(none, own, hashes, texts):
            marks = [sketch(t) for t in texts] if similar else []
            prints = [_signed(fingerprint(t, shingle)) for t in texts]
            return [none, own, hashes, prints, *([[m[i] for m in marks] for i in (0, 1)] if similar else [])]

        return work

    keyed = df.withColumns(key)
    schema = f"__none boolean, __own {kind.simpleString()}, __hash bigint, fp bigint" + (", keys array<bigint>, marks binary" if similar else "")
    prints = map_columns(keyed, [*key, text_col], make, schema).checkpoint()
    classes = prints.groupBy("fp").agg(F.min(F.struct(*key)).alias("first"))
    edges = links(classes.select("fp"), distance)
    if similar:
        edges = edges.union(similar_links(prints.select("fp", "keys", "marks")))
    rooted = _rooted(classes.select("fp"), edges)
    firsts = rooted.join(classes, "fp").groupBy("root").agg(F.min("first").alias("first")).select("first.*")
    # rows alike in all columns share a key; the join has sorted them, so one stays without another shuffle
    return keyed.join(firsts, list(key), "left_semi").dropDuplicates(list(key)).select(*(f"`{c}`" for c in df.columns))
