"""Operator 7: toxicity with noisy-channel deobfuscation.

Disguised spellings (digits and signs for letters, stretched letters, letters
set apart) are read as noisy versions of plain words.  Each suspicious token
becomes a lattice of the letters it may stand for; a Viterbi search under a
character trigram model of the whole corpus finds the likeliest reading.  The
restored text is then scored by a logistic classifier learned from labelled rows.

Its features are words and word beginnings.  They are chosen by covering: the
feature that best explains the positive rows not explained yet is taken until
few are left, so words that merely share documents with a feature (in groups of
copies, for instance) are never taken.  Their weights are fitted together on the
positive and negative rows, with a prior at each feature's own log odds.  A text
without any of them has a score below one half.

A null or empty text has no words and gets the lowest score.  Rows are
independent; a row without an id is scored and is neither held out nor trained
on.  Labels of rows that repeat an id count as positive if any is, null labels
do not count.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curiota.llm.arrow import ensure_checkpoint_dir, filter_rows, gather_columns, map_columns

#: Letters that a sign may stand for.
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e",
}
#: Signs that may also stand between letters for nothing.
FILLERS = "*.-_~^'"
#: Log costs of the channel.
SIGN_COST, FILLER_COST, COLLAPSE_COST = -1.0, -0.5, -0.5
#: Bounds: labelled rows that train, prefix lengths, tokens whose reading is remembered.
TRAIN_ROWS = 20_000
PREFIXES = (4, 5, 6, 7)
MEMO_LENGTH = 64

_WORD = re.compile(r"[^\W\d_]+")
_READABLE = re.compile(rf"(?:[^\W\d_]|[{re.escape(''.join(SIGNS) + FILLERS)}])+")
_PARTS = frozenset(FILLERS + " ")
_EDGES = "\"'.,;:?()[]{}<>#%&*"
_APART = re.compile(r"(?<!\w)[^\W\d_](?:[ .\-_*][\w@$!|+]){2,}(?!\w)")
_RUN = re.compile(r"\w+")
#: By code point, the last entry for all others: may be a letter; may stand between letters set apart.
_LETTERS = np.array([chr(i).isalpha() for i in range(128)] + [True])
_BETWEEN = np.array([chr(i) in " .-_*" for i in range(128)] + [False])
#: Characters whose positions are searched at a time, and letters of the words that are counted together.
BLOCK, COUNTED = 1 << 20, 4 << 20


@dataclass
class CharacterModel:
    """Interpolated character trigrams over lower-case words with ends ``^`` and ``$``."""

    three: dict[str, float]
    two: dict[str, float] = field(default_factory=dict)
    one: dict[str, float] = field(default_factory=dict)
    total: float = 1.0
    seen: dict[str, float] = field(default_factory=dict, repr=False)

    @classmethod
    def of(cls, counts: dict[str, float]) -> CharacterModel:
        two, one = Counter(), Counter()
        for gram, n in counts.items():
            two[gram[:2]] += n
            one[gram[2]] += n
        return cls(counts, two, one, sum(one.values()) + 1.0)

    def log(self, before: str, c: str) -> float:
        found = self.seen.get(before + c)
        if found is None:
            if len(self.seen) > 200_000:
                self.seen.clear()
            found = self.seen[before + c] = self._log(before, c)
        return found

    def _log(self, before: str, c: str) -> float:
        context = self.two.get(before, 0.0)
        low = (self.one.get(c, 0.0) + 0.5) / (self.total + 50)
        return math.log((self.three.get(before + c, 0.0) + 5.0 * low) / (context + 5.0))


def lattice(token: str) -> list[list[tuple[str, float, int]]]:
    """Edges (letters, log cost, characters consumed) that start at each character."""
    out, run = [], 0
    for i in range(len(token) - 1, -1, -1):
        c = token[i]
        run = run + 1 if i + 1 < len(token) and token[i + 1] == c else 1
        edges = []
        if c.isalpha():
            edges.append((c, 0.0, 1))
            if run >= 3:
                edges += [(c, COLLAPSE_COST, run), (c + c, COLLAPSE_COST, run)]
        else:
            edges += [(x, SIGN_COST, 1) for x in SIGNS.get(c, "")]
            if c in FILLERS or c == " ":
                edges.append(("", FILLER_COST, 1))
        out.append(edges)
    return out[::-1]


def decode(token: str, model: CharacterModel, breaks: bool = False) -> str | None:
    """The likeliest plain reading of a lower-case token, or None if it has none.

    With ``breaks``, signs that may stand for nothing may also end a word.  Readings are chains of letters, so the
    search takes time and memory in proportion to the token.
    """
    waiting: dict[int, dict[str, tuple[float, tuple | None]]] = {0: {"^^": (0.0, None)}}
    for i, starts in enumerate(lattice(token)):
        for state, (score, chain) in waiting.pop(i, {}).items():
            for letters, cost, width in starts:
                s, at = score + cost, state
                for c in letters:
                    s += model.log(at, c)
                    at = at[1] + c
                ends = waiting.setdefault(i + width, {})
                if at not in ends or s > ends[at][0]:
                    ends[at] = (s, (chain, letters) if letters else chain)
                if breaks and not letters and state != "^^":
                    s += model.log(at, "$")
                    if "^^" not in ends or s > ends["^^"][0]:
                        ends["^^"] = (s, (chain, " "))
    last = waiting.get(len(token))
    if not last:
        return None
    chain = max(((score + model.log(state, "$"), state, chain) for state, (score, chain) in last.items()), key=lambda x: x[:2])[2]
    out = []
    while chain is not None:
        chain, letters = chain
        out.append(letters)
    return "".join(reversed(out))


class Restorer:
    """Words of a text, with suspicious tokens restored; readings are remembered within bounds."""

    def __init__(self, model: CharacterModel):
        self.model = model
        self.known: dict[str, tuple[str, ...]] = {}
        self.split: dict[str, tuple[str, ...]] = {}

    def reading(self, token: str) -> tuple[str, ...]:
        """The token as one word, and its words where signs inside it may part them."""
        if token in self.known:
            return self.known[token]
        found = [decode(token, self.model) or ""]
        if found[0] and not _PARTS.isdisjoint(token):
            found += (decode(token, self.model, breaks=True) or "").split()
        out = tuple(w for w in found if w)
        if len(token) <= MEMO_LENGTH:
            if len(self.known) > 50_000:
                self.known.clear()
            self.known[token] = out
        return out

    def parts(self, token: str) -> tuple[str, ...]:
        """The letter runs of a token without signs at its ends, and its readings if the lattice has an edge at each character."""
        if token in self.split:
            return self.split[token]
        out = _WORD.findall(token)
        # "!" at the end may end a sentence or stand for a letter
        for word in {token.rstrip("!"), token}:
            if not word.isalpha() and _READABLE.fullmatch(word):
                out += self.reading(word)
        if len(token) <= MEMO_LENGTH:
            if len(self.split) > 50_000:
                self.split.clear()
            self.split[token] = tuple(out)
        return tuple(out)

    def words(self, text: str | None) -> set[str]:
        low, out = (text or "").lower(), set()
        for token in set(low.split()):
            if not token.isalpha():
                token = token.strip(_EDGES)
                if not token.isalpha():
                    out.update(self.parts(token))
                    continue
            out.add(token)
        for token in set(disguised(low)):
            out.update(self.reading(token))
        return out


def disguised(text: str) -> Iterator[str]:
    """Runs of word characters with a letter three times in a row, and letters set apart.

    The few positions where one can be are found by comparing code points, a block at a time.
    """
    stretched = apart = 0
    for lo in range(0, len(text), BLOCK):
        code = np.frombuffer(text[lo : lo + BLOCK + 3].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        known = np.minimum(code, 128)
        letter, between = _LETTERS[known], _BETWEEN[known]
        for i in (np.flatnonzero((code[:-2] == code[1:-1]) & (code[1:-1] == code[2:]) & letter[:-2]) + lo).tolist():
            if i >= stretched and _WORD.match(text, i):
                start = i
                while start > stretched and _RUN.match(text[start - 1]):
                    start -= 1
                stretched = _RUN.match(text, i).end()
                yield text[start:stretched]
        for i in (np.flatnonzero(letter[:-3] & between[1:-2] & between[3:]) + lo).tolist():
            if i >= apart and (found := _APART.match(text, i)):
                apart = found.end()
                yield found[0]


def features(words: set[str]) -> set[str]:
    """Words, and word beginnings marked by a star."""
    out = set(words)
    for w in words:
        n = len(w)
        for k in PREFIXES:
            if n > k:
                out.add(w[:k] + "*")
    return out


class Trigrams:
    """Counts of character trigrams over lower-case runs of letters; words are counted first, as many as fit a bound."""

    def __init__(self):
        self.words: Counter[str] = Counter()
        self.letters = 0

    def add(self, texts: list[str | None]) -> list[list] | None:
        for text in texts:
            before = len(self.words)
            tokens = Counter((text or "").lower().split())
            for token, n in tokens.items():
                for word in (token,) if token.isalpha() else _WORD.findall(token):
                    self.words[word] += n
            # a new word is counted as its text's mean, so that only sums are kept
            self.letters += (len(self.words) - before) * (1 + len(text or "") // max(1, len(tokens)))
        return self.take() if self.letters > COUNTED else None

    def take(self) -> list[list]:
        grams: Counter[str] = Counter()
        for word, n in self.words.items():
            padded = f"^^{word}$"
            for i in range(len(word) + 1):
                grams[padded[i : i + 3]] += n
        self.words.clear()
        self.letters = 0
        return [list(grams), list(grams.values())]


def character_model(df: DataFrame, text_col: str = "text") -> CharacterModel:
    """Trigram counts of the corpus, all of them; their number grows with the scripts of the corpus, not with its size."""
    rows = gather_columns(df, [text_col], Trigrams, "g string, n bigint").groupBy("g").agg(F.sum("n").alias("n")).collect()
    return CharacterModel.of({r["g"]: float(r["n"]) for r in rows})


def held_out(id_col: str):
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def _logistic(x):
    return 1.0 / (1.0 + np.exp(-x))


def _log_odds(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1.0 - p))


@dataclass(frozen=True)
class Classifier:
    """Weights by feature, the log odds of a text without any, and the model that restores."""

    weights: dict[str, float]
    bias: float
    model: CharacterModel

    def scorer(self):
        restorer = Restorer(self.model)
        known = frozenset(self.weights)
        lengths = sorted({len(k) - 1 for k in known if k.endswith("*")})
        least = lengths[0] if lengths else 0
        heads = frozenset(k[:least] for k in known if k.endswith("*"))

        def score(text: str | None) -> float:
            words = restorer.words(text)
            held = words & known
            for w in [w for w in words if w[:least] in heads]:
                for k in lengths:
                    if len(w) > k and w[:k] + "*" in known:
                        held.add(w[:k] + "*")
            p = float(_logistic(self.bias + math.fsum(self.weights[f] for f in held)))
            return p if text else p / 2

        return score


def fit(rows: dict[tuple[str, ...], tuple[int, int]], precision: dict[str, float], prior: float = 1.0) -> tuple[dict[str, float], float]:
    """Weights and bias of a logistic regression, from (positive, all) rows by the features that they have.

    The bias is that of rows without any feature, below one half; weights have a normal prior around the log odds of
    ``precision``, of which ``prior`` is the reciprocal variance.
    """
    positive, n = rows.get((), (0, 0))
    bias = _log_odds(min(0.45, (positive + 0.5) / (n + 1)))
    names = sorted(precision)
    if not names:
        return {}, bias
    held = sorted(k for k in rows if k)
    place = {f: i for i, f in enumerate(names)}
    x = np.zeros((len(held), len(names)))
    for i, k in enumerate(held):
        x[i, [place[f] for f in k]] = 1.0
    y, total = (np.array([rows[k][j] for k in held], dtype=float) for j in (0, 1))
    mean = np.array([_log_odds(precision[f]) - bias for f in names])
    w = mean.copy()
    for _ in range(100):
        p = _logistic(x @ w + bias)
        slope = x.T @ (y - total * p) - prior * (w - mean)
        curve = (x * (total * p * (1 - p))[:, None]).T @ x + prior * np.eye(len(names))
        step = np.linalg.solve(curve, slope)
        w += step / max(1.0, float(np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return dict(zip(names, w.tolist(), strict=True)), bias


def cover(
    positives: list[set[str]], a: dict[str, int], b: dict[str, int], base: float, times: int = 2, least_precision: float = 0.7
) -> dict[str, float]:
    """Features that explain every positive row up to ``times`` times, best first.

    A feature is taken while it explains three rows or more (a half percent
    once every row is explained) that are not explained ``times`` times yet.
    """
    precision = {f: (a[f] + 4 * base) / (a[f] + b.get(f, 0) + 4) for f in a}
    holders: dict[str, list[int]] = {}
    for i, row in enumerate(positives):
        for f in row:
            if precision[f] >= least_precision:
                holders.setdefault(f, []).append(i)
    need, out = [times] * len(positives), {}
    gain = {f: len(rows) for f, rows in holders.items()}
    few = max(3, len(positives) // 200)
    while gain:
        f = max(gain, key=lambda x: (gain[x] * precision[x] ** 2, -len(x), x))
        if gain[f] < (3 if max(need) == times else few):
            break
        out[f] = precision[f]
        # a longer or shorter form of one word explains nothing new
        stem = f.rstrip("*")
        for g in [g for g in gain if g.startswith(stem) or stem.startswith(g.rstrip("*"))]:
            del gain[g]
        for i in holders[f]:
            need[i] -= 1
            if need[i] == 0:
                for g in positives[i]:
                    if g in gain:
                        gain[g] -= 1
    return out


def train(
    df: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> Classifier:
    """Learn from at most ``rows`` labelled rows, none of them held out.

    The character model covers all of ``df``.  The chosen ids (bounded by
    ``rows``) are broadcast to find their texts; the features that are mostly
    in positive rows and, for each row, which of them it has reach the driver.
    """
    ensure_checkpoint_dir(df.sparkSession)
    model = character_model(df, text_col)
    chosen = (
        labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"))
        .where(~held_out("id") & F.col("label").isNotNull())
        .groupBy("id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(rows)
    )
    texts = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    taken = texts.join(F.broadcast(chosen), "id").select("label", "text")

    def make_words():
        restorer = Restorer(model)
        return lambda label, text: [label, [sorted(restorer.words(t)) for t in text]]

    rows_of = map_columns(taken, ["label", "text"], make_words, "label int, words array<string>").checkpoint()
    positive, negative = rows_of.where("label = 1"), rows_of.where("label = 0")
    n_positive, n_negative = positive.count(), negative.count()
    base = n_positive / max(1, n_positive + n_negative)

    def counted(part: DataFrame) -> DataFrame:
        def make():
            def work(words):
                seen: Counter[str] = Counter()
                for w in words:
                    seen.update(features(set(w)))
                return [list(seen), list(seen.values())]

            return work

        return map_columns(part, ["words"], make, "f string, n bigint").groupBy("f").agg(F.sum("n").alias("n"))

    often, against = counted(positive).where("n >= 4"), counted(negative).withColumnRenamed("n", "m")
    mostly = often.join(against, "f", "left").select("f", "n", F.coalesce("m", F.lit(0)).alias("m")).where("n >= 0.6 * (n + m)").collect()
    a, b = ({r["f"]: r[c] for r in mostly} for c in ("n", "m"))

    def held(part: DataFrame, only: frozenset[str]) -> list:
        """Rows of ``part`` by which of the features they have: (features, positive rows, rows)."""

        def make():
            return lambda label, words: [label, [sorted(features(set(w)) & only) for w in words]]

        found = map_columns(part, ["label", "words"], make, "label int, f array<string>")
        return found.groupBy("f").agg(F.count_if(F.col("label") == 1).alias("positive"), F.count("*").alias("n")).collect()

    positives = [set(r["f"]) for r in (held(positive, frozenset(a)) if a else []) for _ in range(r["n"] if r["f"] else 0)]
    precision = cover(positives, a, b, base)
    seen = {tuple(r["f"]): (r["positive"], r["n"]) for r in held(rows_of.where("label in (0, 1)"), frozenset(precision))}
    return Classifier(*fit(seen, precision), model)


def score(df: DataFrame, learned: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score`` of every text."""

    def make():
        one = learned.scorer()
        return lambda keys, texts: [keys, [one(t) for t in texts]]

    kind = df.schema[id_col].dataType.simpleString()
    return map_columns(df, [id_col, text_col], make, f"`{id_col}` {kind}, score double")


def toxicity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, held_out, score, predicted`` of every text."""
    scored = score(df, train(df, labels, id_col=id_col, text_col=text_col), id_col, text_col)
    return scored.select(
        id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def drop_toxic(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, with all their columns, whose score is below one half."""
    learned = train(df, labels, id_col=id_col, text_col=text_col)

    def make():
        one = learned.scorer()
        return lambda texts: [one(t) < 0.5 for t in texts]

    return filter_rows(df, text_col, make)
