"""Operator 6: best-two-fit packing of tokenized documents.

Documents become pieces of at most ``capacity`` tokens; only longer documents
are cut, into full pieces and a last one.  Pieces are dealt to tasks by a hash
and packed there: a bin is filled greedily with the largest piece that fits,
then its smallest piece is put back for two unpacked pieces if those fill the
widened gap more tightly.  Tokens never leave the task that made them; rows of
a few numbers travel.

A null text counts as empty; an empty document is its end token alone.  Rows
that repeat an id, or have none, are packed each on its own.  Equal lengths go by id and piece.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curiota.llm.arrow import map_columns, released
from curiota.llm.bpe import merge_list

#: Fixed value: the word pattern of the lower-casing vocabulary.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Longer words (in bytes) are merged on their own and not remembered.
LONG_WORD = 64
#: Ids of words that are merged together; bytes of remembered words in each of two generations, and of an entry besides its text.
CELLS, MEMORY_BYTES, ENTRY_BYTES = 1 << 16, 48 << 20, 200
#: Widths to which words are filled up.
WIDTHS = (1, 3, 5, 7, 9, 11, 13, 16, 20, 28, 40, LONG_WORD)
#: Characters of texts that are encoded together.
GROUP = 1 << 22
GROUP_ROWS = 4096
NO_RANK = (1 << 31) - 1
#: Python splits at these four separators, the vocabulary's pattern does not.
_CONTROLS = re.compile("[\x1c-\x1f]")


class PairTable:
    """Ranks of pairs of ids as an open hash table, for many pairs at once."""

    def __init__(self, ranks: dict[int, int]):
        self.bits = max(4, (4 * len(ranks)).bit_length())
        self.keys, self.ranks = np.full(1 << self.bits, -1, dtype=np.int64), np.full(1 << self.bits, NO_RANK, dtype=np.int32)
        keys, values = np.array(list(ranks), dtype=np.int64), np.array(list(ranks.values()), dtype=np.int32)
        at = self._place(keys)
        while keys.size:
            free = np.flatnonzero(self.keys[at] < 0)
            # of several keys for one slot the last one is in, the others go on
            self.keys[at[free]] = keys[free]
            inside = self.keys[at] == keys
            self.ranks[at[inside]] = values[inside]
            keys, values, at = keys[~inside], values[~inside], at[~inside] + 1 & (1 << self.bits) - 1

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view(np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs; ``NO_RANK`` for pairs that never merge, such as those with an id below zero."""
        keys = left.astype(np.int64) << 24 | right.astype(np.int64)
        at = self._place(keys)
        there, out = self.keys[at], self.ranks[at]
        other = np.flatnonzero(there != keys)
        while other.size:
            other = other[there[other] >= 0]
            at[other] = at[other] + 1 & (1 << self.bits) - 1
            there[other], out[other] = self.keys[at[other]], self.ranks[at[other]]
            other = other[there[other] != keys[other]]
        out[there != keys] = NO_RANK
        return out


class WordEncoder:
    """Ids of the lower-casing word vocabulary, as little-endian unsigned 32-bit bytes.

    Words that are not remembered are merged together, a merge of each word at a time.
    """

    def __init__(self, path: str):
        self.merges = merge_list(path)
        self.find = regex.compile(WORD_PATTERN).findall
        self.pairs = PairTable(self.merges.ranks)
        self.made = np.array(self.merges.made, dtype=np.int32)
        self.plain, self.last = np.array(self.merges.first, dtype=np.int32), np.array(self.merges.last, dtype=np.int32)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.weight = 0

    def merged(self, words: list[str]) -> list[bytes]:
        """The ids of every word, in order."""
        raw = [w.encode("utf-8", "replace") for w in words]
        out: list[bytes] = [b""] * len(raw)
        sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        order = np.argsort(sizes, kind="stable")
        # words of like length together, within a bound of cells
        classes = np.searchsorted(WIDTHS, sizes[order], side="left")
        cuts = [0, *(np.flatnonzero(np.diff(classes)) + 1).tolist(), len(raw)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if lo == hi:
                continue
            if (kind := int(classes[lo])) == len(WIDTHS):
                for i in order[lo:hi].tolist():
                    ids = self.merges.ids_of(self.merges.spelled(words[i], True))
                    out[i] = np.array(ids, dtype="<u4").tobytes()
                continue
            step = CELLS // WIDTHS[kind]
            for at in range(lo, hi, step):
                some = order[at : min(hi, at + step)].tolist()
                for i, ids in zip(some, self._together([raw[i] for i in some]), strict=True):
                    out[i] = ids
        return out

    def _together(self, raw: list[bytes]) -> list[bytes]:
        sizes = np.array([len(r) for r in raw])
        width = int(sizes.max())
        ids = np.full((sizes.size, width), -1, dtype=np.int32)
        inside = np.arange(width) < sizes[:, None]
        ids[inside] = self.plain[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        rows = np.arange(sizes.size)
        ids[rows, sizes - 1] = self.last[np.array([r[-1] for r in raw])]
        left = sizes.copy()
        if width > 1:
            ranks = np.full((sizes.size, width), NO_RANK, dtype=np.int32)
            both = inside[:, 1:]
            ranks[:, :-1][both] = self.pairs.of(ids[:, :-1][both], ids[:, 1:][both])
            columns, done = np.arange(width), np.empty_like(ids)
            while True:
                best = ranks.argmin(axis=1)
                rank = ranks[np.arange(rows.size), best]
                more = rank != NO_RANK
                if not more.all():
                    done[rows[~more]] = ids[~more]
                    rows, ids, ranks, best, rank = rows[more], ids[more], ranks[more], best[more], rank[more]
                if not rows.size:
                    break
                here = np.arange(rows.size)
                ids[here, best] = self.made[rank]
                # what lies behind the pair moves up by one
                from_ = np.minimum(columns + (columns > best[:, None]), width - 1)
                ids = np.take_along_axis(ids, from_, axis=1)
                ids[:, -1] = -1
                ranks = np.take_along_axis(ranks, np.minimum(columns + (columns >= best[:, None]), width - 1), axis=1)
                ranks[:, -1] = NO_RANK
                left[rows] -= 1
                after, before = np.flatnonzero(best + 1 < left[rows]), np.flatnonzero(best > 0)
                ranks[after, best[after]] = self.pairs.of(ids[after, best[after]], ids[after, best[after] + 1])
                ranks[before, best[before] - 1] = self.pairs.of(ids[before, best[before] - 1], ids[before, best[before]])
            ids = done
        flat, ends = ids[np.arange(width) < left[:, None]].astype("<u4").tobytes(), (4 * np.cumsum(left)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def _learn(self, chunks: set[str]) -> None:
        """Remember the ids of stretches without white space."""
        known, find = self.known, self.find
        words = [c for c in chunks if c.isalpha()]
        parts = {c: find(c) for c in chunks.difference(words)}
        inner = set().union(*parts.values()).difference(words)
        words += inner
        of = dict(zip(words, self.merged(words), strict=True))
        for c, found in parts.items():
            of[c] = of[found[0]] if len(found) == 1 else b"".join([of[w] for w in found])
        for w in inner.difference(parts):
            del of[w]
        known.update(of)
        self.weight += sum(map(len, of)) + sum(map(len, of.values())) + ENTRY_BYTES * len(of)

    def _words(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        # lower-casing goes by character: no final sigma
        text = text.lower() if "Σ" not in text else "".join([c.lower() for c in text])
        return [text] if _CONTROLS.search(text) else text.split()

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of every text, in groups that hold a bounded number of characters or one text."""
        group, size = [], 0
        for t in texts:
            if group and size + len(t or "") > GROUP:
                yield from self._encode(group)
                group, size = [], 0
            group.append(t)
            size += len(t or "")
        yield from self._encode(group)

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        """A full memory becomes the older one, from which entries in use come back."""
        cut = [[self._words(p) if s is None else s for p, s in self.merges.parts(t)] if t else [] for t in texts]
        if self.weight > MEMORY_BYTES:
            self.older, self.known, self.weight = self.known, {}, 0
        wanted: set[str] = set()
        for parts in cut:
            for p in parts:
                if isinstance(p, list):
                    wanted.update(p)
        wanted.difference_update(self.known)
        back = wanted.intersection(self.older)
        if back:
            again = {w: self.older[w] for w in back}
            self.known.update(again)
            self.weight += sum(map(len, again)) + sum(map(len, again.values())) + ENTRY_BYTES * len(again)
        self._learn(wanted - back)
        of = self.known.__getitem__
        out = [b"".join([b"".join(map(of, p)) if isinstance(p, list) else np.array([p], dtype="<u4").tobytes() for p in parts]) for parts in cut]
        for w in [w for w in wanted if len(w) > LONG_WORD]:
            self.weight -= len(w) + len(self.known.pop(w)) + ENTRY_BYTES
        return out


_ENCODERS: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def pieces(
    df: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, piece, start, length, ids_crc32``: a row per piece of every document."""

    def make():
        encode, end = word_encoder(path).encode, np.array([end_id], dtype="<u4").tobytes()

        def work(keys, texts):
            out = []
            for key, ids in zip(keys, encode(texts), strict=True):
                ids += end
                n = len(ids) // 4
                for i, at in enumerate(range(0, n, capacity)):
                    out.append((key, i, at, min(capacity, n - at), zlib.crc32(ids[4 * at : 4 * (at + capacity)])))
            return [list(c) for c in zip(*out, strict=True)] if out else [[], [], [], [], []]

        return work

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return map_columns(df.select(F.col(f"`{id_col}`").alias("id"), f"`{text_col}`"), ["id", text_col], make, schema, GROUP_ROWS)


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each piece; equal lengths are taken in the given order."""
    order = np.argsort(lengths, kind="stable")
    sizes = lengths[order]
    first = np.searchsorted(sizes, np.arange(capacity + 2))
    stacks = [order[first[n] : first[n + 1]][::-1].tolist() for n in range(capacity + 1)]
    there = sum(1 << n for n in range(1, capacity + 1) if stacks[n])
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)

    def largest(most: int) -> int:
        return (there & ((2 << most) - 1)).bit_length() - 1 if most > 0 else -1

    number = 0
    while there > 0:
        taken, gap = [], capacity
        while (n := largest(gap)) > 0:
            taken.append((n, stacks[n].pop()))
            if not stacks[n]:
                there ^= 1 << n
            gap -= n
        if gap and there > 0:
            small, back = taken[-1]
            room, best, pair = gap + small, small, None
            a = largest(room - 1)
            while a > 0 and 2 * a > best:
                b = largest(min(room - a, a))
                if b == a and len(stacks[a]) < 2:
                    b = largest(a - 1)
                if b > 0 and a + b > best:
                    best, pair = a + b, (a, b)
                    if best == room:
                        break
                a = largest(a - 1)
            if pair:
                taken.pop()
                for n in pair:
                    taken.append((n, stacks[n].pop()))
                    if not stacks[n]:
                        there ^= 1 << n
                stacks[small].append(back)
                there |= 1 << small
        at = 0
        for n, i in taken:
            bins[i], offsets[i] = number, at
            at += n
        number += 1
    return bins, offsets


def pack(cut: DataFrame, capacity: int = 2048) -> DataFrame:
    """``cut`` (from :func:`pieces`) with ``sequence_id`` and ``offset`` added.

    A task packs what it is dealt, so at most one loosely filled sequence per
    task is lost against packing everything at once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), schema=None) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        table = table.sort_by([("id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        bins, offsets = best_two_fit(table.column("length").to_numpy(), capacity)
        base = TaskContext.get().partitionId() << 40
        table = table.append_column("sequence_id", pa.array(bins + base)).append_column("offset", pa.array(offsets))
        yield from table.combine_chunks().to_batches(max_chunksize=65536)

    dealt = cut.repartition("id", "piece")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema)
    return dealt.mapInArrow(released(run), f"{kinds}, sequence_id bigint, offset bigint")


def pack_documents(
    df: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece."""
    return pack(pieces(df, path, capacity, end_id, id_col, text_col), capacity).withColumnRenamed("id", id_col)
