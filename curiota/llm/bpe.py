"""Byte-pair encoding as a bounded-lookahead streaming transducer, compiled state by state.

A merge list decides every token boundary from a bounded stretch of text to
its right.  Write rule k as ``u_k + v_k``.  Let a text be cut in two at a gap.
Until the first merge across the gap both sides evolve alone, so the gap is
crossed exactly if some rule k finds ``u_k`` as the last token of the left
side and ``v_k`` as the first token of the right side at its turn.  Whether
the right side starts with ``v_k`` at that turn depends on ``len(v_k)`` bytes
and on an earlier rule m crossing the end of ``v_k``, for which ``u_m`` has to
be a suffix of ``v_k``.  Hence

    reach(k) = len(v_k) + max(reach(m) for m < k if u_m is a suffix of v_k)

and ``lookahead = max reach`` bytes right of a gap settle it for good.

The same argument makes the tokenizer finite.  A sequence of tokens is the
encoding of its text exactly if every two neighbours are the encoding of
theirs.  So each prefix of a text has one last token, the only one that fits
the last token before it, and a later token can only start at a *live* place:
one from which the text read so far begins a token.  What the encodings of all
live places share at the front is settled.  The transducer emits it and
forgets its bytes; the bytes that are left, at most ``lookahead`` of them, are
its state.  The splitting of text into pre-tokens is part of the state too.

States and transitions are made when a text first takes them; every transition
carries the tokens it emits.  The tables are arrays, and texts are read in
lockstep: a batch is cut into *lanes* at gaps between a visible character and
white space, where a pre-token ends on either side's own account, so the map of
a lane sends every state to the start state; all lanes take one step at a time.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import regex

#: The endings that the pre-tokenizers of both vocabulary families split off.
ENDINGS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
#: Transitions that a compiled machine keeps between blocks; beyond it the machine is compiled anew.
TRANSITIONS = 400_000
#: Characters that are read in lockstep, and of a lane where it can be cut.
BLOCK, LANE = 1 << 18, 256
#: Fewer lanes than this are read one by one.
FEW = 6
_NONE = 1 << 60
#: What follows the last character.
_END = 0x110000
_LETTER, _NUMBER, _WHITE = (regex.compile(p).match for p in (r"\p{L}", r"\p{N}", r"\s"))


def byte_symbols() -> list[str]:
    """The printable symbol that stands for each byte in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def sufficient_lookahead(merges: list[tuple[str, str]]) -> int:
    """Bytes to the right of a gap that decide it, whatever follows."""
    reach_of: dict[str, int] = {}
    most = 0
    for left, right in merges:
        reach = len(right) + max((reach_of.get(right[i:], 0) for i in range(len(right))), default=0)
        if reach > reach_of.get(left, 0):
            reach_of[left] = reach
        most = max(most, reach)
    return most


class MergeList:
    """A merge list over token ids, with its vocabulary, special strings and lookahead.

    A token's ``spelling`` has one character a byte; in vocabularies with word
    ends, the byte that ends a word is shifted by 256.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        vocab: dict[str, int] = model["vocab"]
        end = model.get("end_of_word_suffix") or ""
        symbols = byte_symbols()
        byte_of = {s: b for b, s in enumerate(symbols)}
        self.first = [vocab[s] for s in symbols]
        self.last = [vocab[s + end] for s in symbols] if end else None
        #: rank of a pair of ids, and the id that each rank makes
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for rank, (a, b) in enumerate(merges):
            self.ranks.setdefault(vocab[a] << 24 | vocab[b], rank)
            self.made.append(vocab[a + b])
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.lookahead = sufficient_lookahead(merges)
        self.spelling: dict[int, str] = {}
        self.bytes_of: dict[int, bytes] = {}
        for token, number in vocab.items():
            ends = bool(end) and token.endswith(end)
            plain = token[: -len(end)] if ends else token
            if plain and all(c in byte_of for c in plain):
                raw = bytes(byte_of[c] for c in plain)
                self.bytes_of[number] = raw
                spelled = raw.decode("latin-1")
                self.spelling[number] = spelled[:-1] + chr(256 + raw[-1]) if ends else spelled
        for token, number in self.specials.items():
            self.bytes_of[number] = token.encode("utf-8")
            self.spelling.pop(number, None)
        self.decimal = [str(n) for n in range(max(self.bytes_of) + 1)]
        self.tokens = {s: n for n, s in self.spelling.items()}
        #: every beginning of a token that is not the whole of it
        self.begins = {s[:i] for s in self.tokens for i in range(1, len(s))}
        order = sorted(self.specials, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, order)) + ")") if order else None

    def spelled(self, piece: str, ends: bool = False) -> str:
        raw = piece.encode("utf-8", "replace")
        plain = raw.decode("latin-1")
        return plain[:-1] + chr(256 + raw[-1]) if ends and self.last and raw else plain

    def ids_of(self, spelled: str) -> list[int]:
        """The tokens of a stretch on its own: the merge list, rule by rule."""
        return self.settle([self.first[ord(c)] if c < "Ā" else self.last[ord(c) - 256] for c in spelled])

    def settle(self, ids: list[int]) -> list[int]:
        """All merges over a list of ids: lowest rank first, leftmost on ties."""
        if len(ids) > 48:
            return self._settle_long(ids)
        get = self.ranks.get
        ranks = [get(a << 24 | b, _NONE) for a, b in zip(ids, ids[1:])]  # noqa: B905
        while ranks:
            best = min(ranks)
            if best == _NONE:
                break
            i = ranks.index(best)
            made = ids[i] = self.made[best]
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get(made << 24 | ids[i + 1], _NONE)
            if i:
                ranks[i - 1] = get(ids[i - 1] << 24 | made, _NONE)
        return ids

    def _settle_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list."""
        n, get = len(ids), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := get(ids[i] << 24 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            # a pair that another merge has changed since is stale
            if ids[i] < 0 or j >= n or get(ids[i] << 24 | ids[j]) != rank:
                continue
            ids[i], ids[j] = self.made[rank], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := get(ids[i] << 24 | ids[k])) is not None:
                    heapq.heappush(heap, (r, i))
            if (k := before[i]) >= 0 and (r := get(ids[k] << 24 | ids[i])) is not None:
                heapq.heappush(heap, (r, k))
        return [x for x in ids if x >= 0]

    def parts(self, text: str):
        """(stretch of ordinary text, special id or None), in order."""
        if self.special is None or self.special.search(text) is None:
            yield text, None
            return
        for i, part in enumerate(self.special.split(text)):
            if i % 2:
                yield "", self.specials[part]
            elif part:
                yield part, None


_LISTS: dict[str, MergeList] = {}


def merge_list(path: str) -> MergeList:
    """The merge list of a file, read once per Python worker."""
    if path not in _LISTS:
        _LISTS[path] = MergeList(path)
    return _LISTS[path]


_EMPTY = ("", (None,), (-1,), (0,))


class Transducer:
    """The compiled tokenizer of a vocabulary.

    A state is (mode, aux, core): where in a pre-token the text is, and what is
    not settled of it as (bytes, last token at each place, where that token
    starts, live places).  Transitions are found by state and character in an
    open hash table, and have a next state and a stretch of ``emitted``.
    """

    def __init__(self, merges: MergeList):
        self.merges = merges
        self.words = merges.last is not None
        self.whole = {e: merges.ids_of(merges.spelled(e, True)) for e in ENDINGS}
        self.second = {e[1]: e[2] for e in ENDINGS if len(e) == 3}
        self.kinds: dict[str, str] = {}
        #: all white space lies below this character
        self.white = np.array([bool(_WHITE(chr(c))) for c in range(0x3002)])
        self._forget()

    def _forget(self) -> None:
        """Drop what is compiled."""
        self.states: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.fit: dict[int, bool] = {}
        self.keys = np.full(1 << 18, -1, dtype=np.int64)
        self.slots = np.zeros(1 << 18, dtype=np.int32)
        self.made, self.kept, self._sized = 0, 0, self.keys.size
        self.next = np.zeros(1 << 16, dtype=np.int32)
        self.first, self.many = np.zeros(1 << 16, dtype=np.int32), np.zeros(1 << 16, dtype=np.int32)
        self.emitted = np.zeros(1 << 16, dtype=np.uint32)
        self._state("start", "", _EMPTY)

    def _state(self, mode: str, aux: str, core: tuple) -> int:
        number = self.numbers.setdefault((mode, aux, core[0]), len(self.states))
        if number == len(self.states):
            self.states.append((mode, aux, core))
        return number

    def _fits(self, a: int | None, b: int) -> bool:
        """Whether two tokens beside each other, or one alone, are the encoding of their text."""
        key = b if a is None else a + 1 << 24 | b
        found = self.fit.get(key)
        if found is None:
            spelling = self.merges.spelling
            text, ids = (spelling[b], [b]) if a is None else (spelling[a] + spelling[b], [a, b])
            found = self.fit[key] = self.merges.ids_of(text) == ids
        return found

    def _push(self, core: tuple, symbol: str, out: list[int]) -> tuple:
        rest, lasts, starts, live = core
        rest += symbol
        tokens, begins = self.merges.tokens, self.merges.begins
        for at in live:
            token = tokens.get(rest[at:])
            if token is not None and self._fits(None, token) and (at == 0 or self._fits(lasts[at], token)):
                break
        lasts, starts = (*lasts, token), (*starts, at)
        live = [j for j in live if rest[j:] in begins]
        live.append(len(rest))
        settled = self._common(live, starts) if live[0] else 0
        if settled:
            out += self._chain(lasts, starts, settled)
            rest, lasts = rest[settled:], (None, *lasts[settled + 1 :])
            starts, live = (-1, *[s - settled for s in starts[settled + 1 :]]), [j - settled for j in live]
        return rest, lasts, starts, tuple(live)

    @staticmethod
    def _common(live: list[int], starts: tuple[int, ...]) -> int:
        """The last place through which the encodings of all live places go."""
        places = set(live)
        while len(places) > 1:
            top = max(places)
            places.remove(top)
            places.add(starts[top])
        return places.pop()

    @staticmethod
    def _chain(lasts: tuple, starts: tuple, place: int) -> list[int]:
        out = []
        while place:
            out.append(lasts[place])
            place = starts[place]
        return out[::-1]

    def _feed(self, aux: str, core: tuple, c: str, out: list[int]) -> tuple[str, tuple]:
        """(symbol that waits for its successor, core): only vocabularies with word ends need to wait."""
        symbols = aux + self.merges.spelled(c)
        if self.words:
            symbols, aux = symbols[:-1], symbols[-1]
        for s in symbols:
            core = self._push(core, s, out)
        return aux, core

    def _finish(self, aux: str, core: tuple, out: list[int]) -> None:
        if self.words and aux:
            core = self._push(core, chr(256 + ord(aux)), out)
        rest, lasts, starts, _ = core
        out += self._chain(lasts, starts, len(rest))

    def _alone(self, piece: str, out: list[int]) -> None:
        out += self.merges.ids_of(self.merges.spelled(piece, True))

    def _next(self, mode: str, aux: str, core: tuple, c: str, out: list[int]) -> tuple[str, str, tuple]:
        kind = self.kinds.get(c)
        if kind is None:
            kind = self.kinds[c] = "L" if _LETTER(c) else "N" if _NUMBER(c) else "S" if _WHITE(c) else "O"
        if mode == "S":
            if kind == "S":
                return "S", c, self._feed("", core, aux, out)[1]
            self._finish("", core, out)
            if aux == " ":  # the last space goes with the word that follows
                return kind, "", self._feed("", self._feed("", _EMPTY, " ", out)[1], c, out)[1]
            self._alone(aux, out)
        elif mode in ("L", "N", "O"):
            if kind == mode:
                return mode, *self._feed(aux, core, c, out)
            self._finish(aux, core, out)
        elif mode == "quote":
            if "'" + c in self.whole:
                out += self.whole["'" + c]
                return "start", "", _EMPTY
            if c in self.second:
                return "ending", c, _EMPTY
            if kind == "O":
                return "O", *self._feed(*self._feed("", _EMPTY, "'", out), c, out)
            self._alone("'", out)
        elif mode == "ending":
            if c == self.second[aux]:
                out += self.whole["'" + aux + c]
                return "start", "", _EMPTY
            self._alone("'", out)
            if kind == "L":
                return "L", *self._feed(*self._feed("", _EMPTY, aux, out), c, out)
            self._alone(aux, out)
        if kind == "S":
            return ("start", "", _EMPTY) if self.words else ("S", c, _EMPTY)
        if c == "'":
            return "quote", "", _EMPTY
        if kind == "N" and self.words:
            self._alone(c, out)
            return "start", "", _EMPTY
        return kind, *self._feed("", _EMPTY, c, out)

    def _ending(self, mode: str, aux: str, core: tuple) -> list[int]:
        out: list[int] = []
        if mode == "S":
            self._finish("", self._feed("", core, aux, out)[1], out)
        elif mode in ("L", "N", "O"):
            self._finish(aux, core, out)
        elif mode != "start":
            self._alone("'", out)
            if aux:
                self._alone(aux, out)
        return out

    def _compile(self, key: int) -> int:
        """Make the transition of a state and a character; its number."""
        state, code = self.states[key >> 21], key & 0x1FFFFF
        out: list[int] = []
        if code == _END:
            out, then = self._ending(*state), 0
        else:
            then = self._state(*self._next(*state, chr(code), out))
        number, self.made = self.made, self.made + 1
        if self.made > self.next.size:
            self.next, self.first, self.many = (np.concatenate((x, np.zeros_like(x))) for x in (self.next, self.first, self.many))
        while self.kept + len(out) > self.emitted.size:
            self.emitted = np.concatenate((self.emitted, np.zeros_like(self.emitted)))
        self.next[number], self.first[number], self.many[number] = then, self.kept, len(out)
        self.emitted[self.kept : self.kept + len(out)] = out
        self.kept += len(out)
        if 4 * self.made > self.keys.size:
            known = np.flatnonzero(self.keys >= 0)
            keys, slots = self.keys[known], self.slots[known]
            self.keys, self.slots = np.full(4 * self.keys.size, -1, dtype=np.int64), np.zeros(4 * self.slots.size, dtype=np.int32)
            for k, v in zip(keys.tolist(), slots.tolist(), strict=True):
                self._put(k, v)
        self._put(key, number)
        return number

    def _place(self, keys: np.ndarray) -> np.ndarray:
        h = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(65 - self.keys.size.bit_length())).view(np.int64)

    def _put(self, key: int, number: int) -> None:
        at = (key * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 65 - self.keys.size.bit_length()
        while self.keys[at] >= 0:
            at = at + 1 & self.keys.size - 1
        self.keys[at], self.slots[at] = key, number

    def _one(self, key: int) -> int:
        at = (key * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 65 - self.keys.size.bit_length()
        while (there := int(self.keys[at])) != key:
            if there < 0:
                return self._compile(key)
            at = at + 1 & self.keys.size - 1
        return int(self.slots[at])

    def _taken(self, keys: np.ndarray) -> np.ndarray:
        """Transition numbers of all keys."""
        at = self._place(keys)
        there = self.keys[at]
        out = self.slots[at]
        left = np.flatnonzero(there != keys)
        while left.size:
            absent = there[left] < 0
            if absent.any():
                lost = left[absent]
                out[lost] = [self._one(k) for k in keys[lost].tolist()]
                left = left[~absent]
                if at.size and self.keys.size != self._sized:  # grown meanwhile
                    self._sized = self.keys.size
                    at = self._place(keys)
                    there = self.keys[at]
                    out[left] = self.slots[at[left]]
                    left = left[there[left] != keys[left]]
                    continue
            at[left] = at[left] + 1 & self.keys.size - 1
            there[left], out[left] = self.keys[at[left]], self.slots[at[left]]
            left = left[there[left] != keys[left]]
        return out

    def _lanes(self, codes: np.ndarray, edges: list[int]) -> np.ndarray:
        """Where lanes begin: at ``edges`` and, every ``LANE`` characters or later, at synchronising gaps."""
        white = self.white[np.minimum(codes, self.white.size - 1)]
        gaps = np.flatnonzero(white[1:] & ~white[:-1]) + 1
        if gaps.size:
            found = np.searchsorted(gaps, np.arange(LANE, codes.size, LANE))
            gaps = gaps[found[found < gaps.size]]
        return np.unique(np.concatenate((np.array(edges, dtype=np.int64), gaps)))

    def _read(self, codes: np.ndarray, edges: list[int], state: int, more: bool) -> tuple[np.ndarray, np.ndarray, int]:
        """(transition of every character and lane end, where each edge's are, state after the last lane).

        The first lane begins in ``state``, others at the start; with ``more``,
        the text of the last lane goes on in another block.
        """
        begins = self._lanes(codes, edges)
        sizes = np.diff(np.append(begins, codes.size))
        # every lane is followed by its end
        put = np.arange(codes.size) + np.repeat(np.arange(begins.size), sizes)
        tape = np.full(codes.size + begins.size, _END, dtype=np.int64)
        tape[put] = codes
        starts = begins + np.arange(begins.size)
        lengths = sizes + 1
        if more:
            lengths[-1] -= 1
        taken = np.zeros(tape.size, dtype=np.int32)
        order = np.argsort(-lengths, kind="stable")
        at, left = starts[order], lengths[order]
        states = np.zeros(at.size, dtype=np.int64)
        states[order == 0] = state
        n, step, last = at.size, 0, int(np.flatnonzero(order == begins.size - 1)[0])
        while True:
            n = int(np.searchsorted(-left[:n], -step, side="left"))  # lanes with more than ``step`` characters
            if n <= FEW:
                break
            here = at[:n] + step
            now = self._taken(states[:n] << 21 | tape[here])
            taken[here] = now
            states[:n] = self.next[now]
            step += 1
        for i in range(n):
            s = int(states[i])
            for k in range(int(at[i]) + step, int(at[i] + left[i])):
                t = taken[k] = self._one(s << 21 | int(tape[k]))
                s = int(self.next[t])
            states[i] = s
        where = np.searchsorted(begins, np.array(edges, dtype=np.int64))
        end = int(states[last]) if more else 0
        return (taken[:-1] if more else taken), starts[where], end

    def ids(self, taken: np.ndarray) -> np.ndarray:
        """What the transitions emit, in order."""
        many = self.many[taken]
        some = np.flatnonzero(many)
        many, first = many[some].astype(np.int64), self.first[taken[some]].astype(np.int64)
        ends = np.cumsum(many)
        return self.emitted[np.repeat(first - (ends - many), many) + np.arange(int(ends[-1]) if ends.size else 0)]

    def read(self, texts: Iterable[str]) -> Iterator[tuple[int, np.ndarray, int | None]]:
        """(number of the text, transitions, special id) for stretches of all texts, in order; empty texts give none."""
        held: list[tuple[int, str]] = []
        size = 0
        for number, text in enumerate(texts):
            for part, special in self.merges.parts(text):
                if special is not None or size + len(part) > BLOCK:
                    yield from self._together(held)
                    held, size = [], 0
                if special is not None:
                    yield number, np.empty(0, dtype=np.int32), special
                elif len(part) > BLOCK:
                    state = 0
                    for lo in range(0, len(part), BLOCK):
                        self._bound(keep := self.states[state])
                        codes, more = _codes(part[lo : lo + BLOCK]), lo + BLOCK < len(part)
                        taken, _, state = self._read(codes, [0], self._state(*keep), more)
                        yield number, taken, None
                elif part:
                    held.append((number, part))
                    size += len(part)
        yield from self._together(held)

    def _bound(self, keep: tuple | None = None) -> None:
        if self.made > TRANSITIONS:
            self._forget()
            if keep:
                self._state(*keep)

    def _together(self, held: list[tuple[int, str]]) -> Iterator[tuple[int, np.ndarray, None]]:
        if held:
            self._bound()
            edges = np.cumsum([0, *(len(p) for _, p in held)]).tolist()
            taken, starts, _ = self._read(_codes("".join([p for _, p in held])), edges[:-1], 0, False)
            stops = np.append(starts[1:], taken.size)
            for (number, _), lo, hi in zip(held, starts.tolist(), stops.tolist(), strict=True):
                yield number, taken[lo:hi], None

    def encode(self, texts: Iterable[str]) -> Iterator[tuple[int, np.ndarray]]:
        """(number of the text, ids) for stretches of all texts, in order."""
        for number, taken, special in self.read(texts):
            yield number, self.ids(taken) if special is None else np.array([special], dtype=np.uint32)

    def counts(self, texts: list[str]) -> list[int]:
        """Emitted tokens of every text: the counts on its transitions, added up."""
        out = [0] * len(texts)
        for number, taken, special in self.read(texts):
            out[number] += 1 if special is not None else int(self.many[taken].sum())
        return out


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4").astype(np.int64)


_TRANSDUCERS: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """The compiled tokenizer of a file, one per Python worker: what is compiled lives across tasks."""
    if path not in _TRANSDUCERS:
        _TRANSDUCERS.clear()
        _TRANSDUCERS[path] = Transducer(merge_list(path))
    return _TRANSDUCERS[path]
