"""Operator 8: substring deduplication with suffix automata of reference shards.

Every word covered by a window of ``window`` words whose word sequence also
starts earlier (in a smaller id, or earlier in the same document) is removed.

Reference shards are formed by content instead of by position in the corpus: a
window belongs to the shard of its anchor, the least-hashed of the short word
runs inside it, so equal windows meet in one shard and a document visits only
the shards of its own anchors.  (Broadcasting the automata of all shards to all
documents would make work grow with the square of the input.)  In a shard, the
passages around one anchor are streamed in order through a suffix automaton of
the passages before them; matching statistics of ``window`` words and more mark
the windows that started earlier.

1. Anchors are counted.  Two filters of bounded size are built from the counts
   and broadcast: anchors seen twice or more, and frequent ones.  A filter's
   false positives cost work and never change the result.
2. Windows whose anchor is repeated travel to their shard as passages.  Windows
   of frequent anchors travel as their own hash, salted over ``SALTS`` tasks;
   the first of each salt meets the firsts of the others in a second round.
3. Ranges of removed windows join their documents.

Words are runs of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return, unchanged.  A null text has no words.  Rows that
repeat id and text are one document and lose the same words; different texts
with one id are told apart by a hash of the text, which also breaks their tie.
Rows without an id come before all others and lose nothing.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curiota.llm.arrow import ensure_checkpoint_dir, map_columns

#: Words of an anchor; at most the window.
GRAM = 10
#: Anchors seen more often than this are frequent: bounds the passages of a shard group.
FREQUENT = 1000
#: Tasks over which one frequent window is spread.
SALTS = 32
#: Filters have at most this many 64-bit words (64 MB).
FILTER_WORDS = 1 << 23
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: Odd factors of the hashes by seed.
_FACTORS = np.random.default_rng(8).integers(0, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: spreads sums of word hashes."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _signed(x: int) -> int:
    return x - (x >> 63 << 64)


class Words:
    """A text's words with their hashes, and hashes of runs of words."""

    def __init__(self, text: str | None):
        self.words = (text or "").encode("utf-8").split()
        digest = xxhash.xxh64_intdigest
        self.hashes = np.array([digest(w) for w in self.words], dtype=np.uint64)

    def runs(self, length: int, seed: int = 0) -> np.ndarray:
        """Hash of the run of ``length`` words at each place; seeds have word hashes and factors of their own."""
        n = len(self.words) - length + 1
        if n <= 0:
            return np.empty(0, dtype=np.uint64)
        factor = _GOLDEN if not seed else _FACTORS[seed]
        hashes = self.hashes if not seed else _mix(self.hashes * factor + _FACTORS[-seed])
        total = np.zeros(n, dtype=np.uint64)
        for i in range(length):
            total = total * factor + hashes[i : i + n]
        return _mix(total)

    def anchors(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """(place of its anchor for each window, hashes of anchors by place): leftmost least hash."""
        gram = min(GRAM, window)
        grams = self.runs(gram)
        n, width = len(self.words) - window + 1, window - gram + 1
        if n <= 0:
            return np.empty(0, dtype=np.int64), grams
        best, place = grams.copy(), np.arange(grams.size)
        span = 1
        while span < width:
            step = min(span, width - span)
            left, right = best[: best.size - step], best[step:]
            take = right < left
            best, place = np.where(take, right, left), np.where(take, place[step:], place[: place.size - step])
            span += step
        return place[:n], grams


class FixedFilter:
    """A Bloom filter of 64-bit blocks, three bits a key in one block."""

    def __init__(self, blocks: np.ndarray):
        self.blocks = blocks

    @staticmethod
    def place(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        h = _mix(keys ^ _GOLDEN)
        one, six = np.uint64(1), np.uint64(63)
        mask = (one << (h >> np.uint64(40) & six)) | (one << (h >> np.uint64(46) & six)) | (one << (h >> np.uint64(52) & six))
        return (h & np.uint64(size - 1)).astype(np.int64), mask

    def holds(self, keys: np.ndarray) -> np.ndarray:
        at, mask = self.place(keys, self.blocks.size)
        return self.blocks[at] & mask == mask

    @classmethod
    def of(cls, keys: DataFrame) -> FixedFilter:
        """Build from a column ``a`` of longs; at most FILTER_WORDS rows reach the driver."""
        n = keys.count()
        size = 1 << max(10, min(n, FILTER_WORDS).bit_length())
        size = min(size, FILTER_WORDS)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at, mask = cls.place(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), size)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(mask.view(np.int64))], names=["at", "mask"])

        made = keys.select("a").mapInArrow(run, "at bigint, mask bigint").groupBy("at").agg(F.bit_or("mask").alias("mask"))
        table = made.toArrow()
        blocks = np.zeros(size, dtype=np.uint64)
        blocks[table.column("at").to_numpy()] = table.column("mask").to_numpy().view(np.uint64)
        return cls(blocks)


class SuffixAutomaton:
    """Suffix automaton of a growing set of word sequences (generalized by restarting at the root)."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, words: list) -> None:
        last = 0
        for w in words:
            last = self._extend(last, w)

    def _clone(self, p: int, q: int, w) -> int:
        clone = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w) -> int:
        if w in self.next[last]:
            q = self.next[last][w]
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, w)
        cur = len(self.next)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, w)
        return cur

    def statistics(self, words: list) -> list[int]:
        """Length of the longest known run that ends at each word."""
        state, length, out = 0, 0, []
        for w in words:
            while state and w not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if w in self.next[state]:
                state = self.next[state][w]
                length += 1
            out.append(length)
        return out


def _spans(flags: list[bool]) -> Iterator[tuple[int, int]]:
    """(first, count) of each maximal run of true flags."""
    start = None
    for i, f in enumerate([*flags, False]):
        if f and start is None:
            start = i
        elif not f and start is not None:
            yield start, i - start
            start = None


def _earlier(group: list[tuple], window: int) -> Iterator[tuple[int, int, int, int]]:
    """Window ranges (id, text hash, first window, count) of one anchor's passages that started earlier.

    ``group`` holds (id, text hash, first window, passage) in order of occurrence.
    """
    passages: dict[bytes, bool] = {}
    distinct = {g[3] for g in group}
    automaton = SuffixAutomaton() if len(distinct) > 1 else None
    for key, text, start, passage in group:
        words = passage.split()
        if passage in passages:
            yield key, text, start, len(words) - window + 1
            continue
        passages[passage] = True
        if automaton is not None:
            if len(passages) > 1:
                known = automaton.statistics(words)
                for at, n in _spans([x >= window for x in known[window - 1 :]]):
                    yield key, text, start + at, n
            automaton.add(words)


_CANDIDATE = "key bigint, kind int, second bigint, id bigint, text_hash bigint, start int, passage binary"


def _candidates(df: DataFrame, window: int, repeated, frequent) -> DataFrame:
    """Passages (kind 0) and single windows (kind 1) of repeated anchors."""

    def make():
        twice, often = FixedFilter(repeated.value), FixedFilter(frequent.value)

        def one(out, key, text):
            w = Words(text)
            places, grams = w.anchors(window)
            if not places.size:
                return
            kept = twice.holds(grams)[places]
            if not kept.any():
                return
            hot = kept & often.holds(grams)[places]
            th = _signed(xxhash.xxh64_intdigest(text.encode("utf-8")))
            if hot.any():
                at = np.flatnonzero(hot)
                first, second = w.runs(window, 1)[at].view(np.int64), w.runs(window, 2)[at].view(np.int64)
                for a, b, s in zip(first.tolist(), second.tolist(), at.tolist(), strict=True):
                    out.append((a, 1, b, key, th, s, None))
            cold = kept & ~hot
            cut = np.flatnonzero(np.diff(places) | np.diff(cold)) + 1
            edges = np.concatenate(([0], cut, [places.size]))
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if cold[lo]:
                    passage = b" ".join(w.words[lo : hi - 1 + window])
                    out.append((_signed(int(grams[places[lo]])), 0, 0, key, th, lo, passage))

        def work(keys, texts):
            out: list[tuple] = []
            for key, text in zip(keys, texts, strict=True):
                if text:
                    one(out, key, text)
            return [list(c) for c in zip(*out, strict=True)] if out else [[] for _ in range(7)]

        return work

    return map_columns(df, ["id", "text"], make, _CANDIDATE)


_FOUND = "kind int, key bigint, second bigint, id bigint, text_hash bigint, start int, n int"


def _resolve(batches: Iterator[pa.RecordBatch], window: int, last: bool) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, kind, second, id, text hash and start to removed ranges (kind 2).

    Firsts of single windows come out as kind 1 unless this is the last round.
    """
    out: list[tuple] = []
    group: list[tuple] = []
    group_key = single = previous = None

    def flush() -> pa.RecordBatch:
        names = [x.split()[0] for x in _FOUND.split(", ")]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        columns = list(zip(*out, strict=True)) if out else [[] for _ in kinds]
        made = pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)], names=names)
        out.clear()
        return made

    def close() -> None:
        out.extend((2, 0, 0, i, t, s, n) for i, t, s, n in _earlier(group, window))
        group.clear()

    for batch in batches:
        for key, kind, second, i, t, start, passage in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if kind == 0:
                if key != group_key:
                    close()
                    group_key = key
                if previous != (key, i, t, start):  # a repeated row is the same document
                    group.append((i, t, start, passage))
                previous = (key, i, t, start)
            elif (key, second) != single:
                single, previous = (key, second), (key, i, t, start)
                if not last:
                    out.append((1, key, second, i, t, start, 1))
            elif previous != (key, i, t, start):
                previous = (key, i, t, start)
                out.append((2, 0, 0, i, t, start, 1))
            if len(out) >= 20_000:
                yield flush()
    close()
    yield flush()


def removed_windows(df: DataFrame, window: int) -> DataFrame:
    """``id, text_hash, start, n``: ranges of windows that started earlier, from ``id, text``."""
    spark = df.sparkSession

    def make():
        def work(_, texts):
            seen: dict[int, int] = defaultdict(int)
            for text in texts:
                places, grams = Words(text).anchors(window)
                for h in grams[np.unique(places)].view(np.int64).tolist():
                    seen[h] += 1
            return [list(seen), list(seen.values())]

        return work

    counts = map_columns(df, ["id", "text"], make, "a bigint, n bigint").groupBy("a").agg(F.sum("n").alias("n")).where("n > 1")
    counts = counts.checkpoint()
    repeated = spark.sparkContext.broadcast(FixedFilter.of(counts).blocks)
    frequent = spark.sparkContext.broadcast(FixedFilter.of(counts.where(F.col("n") > FREQUENT)).blocks)

    first = _candidates(df, window, repeated, frequent)
    salt = F.when(F.col("kind") == 1, F.pmod(F.xxhash64("id"), F.lit(SALTS))).otherwise(0)
    order = ["key", "kind", "second", "id", "text_hash", "start"]
    dealt = first.repartition(F.col("key"), salt).sortWithinPartitions(*order)
    once = dealt.mapInArrow(lambda b: _resolve(b, window, False), _FOUND)
    # removed ranges pass the second round on their document's key; firsts of the salts meet
    again = once.withColumn("key", F.when(F.col("kind") == 2, F.xxhash64("id")).otherwise(F.col("key")))
    again = again.repartition("key").sortWithinPartitions("key", "kind", "second", "id", "text_hash", "start")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single = None
        for batch in batches:
            kind, key, second, i, t, start, n = (c.to_pylist() for c in batch.columns)
            keep = []
            for at in range(batch.num_rows):
                if kind[at] == 2:
                    keep.append(at)
                elif (key[at], second[at]) != single:
                    single = (key[at], second[at])
                else:
                    keep.append(at)
            yield batch.take(pa.array(keep, type=pa.int64())).select(["id", "text_hash", "start", "n"])

    return again.mapInArrow(finish, "id bigint, text_hash bigint, start int, n int")


def dedup_substrings(df: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_words, n_removed, kept_text``: kept words joined by one space.  Ids are integers."""
    ensure_checkpoint_dir(df.sparkSession)
    docs = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    gone = removed_windows(docs, window).groupBy("id", "text_hash").agg(F.collect_list(F.struct("start", "n")).alias("gone"))
    gone = gone.groupBy("id").agg(F.collect_list(F.struct("text_hash", "gone")).alias("by_text")).withColumnRenamed("id", "gone_id")
    joined = docs.join(gone, F.col("id") == F.col("gone_id"), "left").select("id", "text", "by_text")

    def make():
        def one(text, by_text):
            words = text.encode("utf-8").split()
            if by_text:
                own = _signed(xxhash.xxh64_intdigest(text.encode("utf-8")))
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                for x in by_text:
                    if x["text_hash"] == own:
                        for r in x["gone"]:
                            gone[r["start"]] += 1
                            gone[r["start"] + r["n"] - 1 + window] -= 1
                kept = np.flatnonzero(np.cumsum(gone)[:-1] == 0)
                n = len(words)
                words = [words[i] for i in kept.tolist()]
                return n, n - len(words), b" ".join(words).decode("utf-8")
            return len(words), 0, b" ".join(words).decode("utf-8")

        def work(keys, texts, by_texts):
            out = [one(t, b) for t, b in zip(texts, by_texts, strict=True)]
            return [keys, *(list(c) for c in zip(*out, strict=True))] if out else [keys, [], [], []]

        return work

    out = map_columns(joined, ["id", "text", "by_text"], make, "id bigint, n_words bigint, n_removed bigint, kept_text string")
    return out.withColumnRenamed("id", id_col)


def digest(deduped: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return deduped.select(id_col, "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
