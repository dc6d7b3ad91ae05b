"""Toxicity: Levenshtein automata met with a lexicon trie, and context windows.

The lexicon is learned: words, and stems that words begin with, which labelled toxic
documents hold far more often than others. Its entries form a trie. Each word of a text
is a Levenshtein automaton (of no, one or two edits, by length), and walking the trie
with the automaton's states gives every entry the word may be a misspelling of. Words
that clean documents use, though an edit away from an entry, are learned as innocent.

Few words are near an entry, and those that are share what is left of both when as many
letters are deleted from each. So the hashes of all deletions of many new words are
computed at once and looked up among those of the entries; an automaton is built only
for a word that is found there. A worker remembers words from task to task.

A hit in quotation marks, or near a word that reports speech, counts as quoted, and is
kept apart from abuse; a hit near an address (you) counts more. A logistic regression
over the sums of the hits' weights gives the score. It is trained on other labelled
documents than the lexicon.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.session import stored

from .quality import remainder
from .text import mixed, slices

#: Labelled rows of each class that are learned from, on average: chosen by a hash of
#: doc_id, half for the lexicon and half for the weights.
MOST_ROWS = 10_000
#: Toxic documents of the lexicon's half that must hold an entry, and how much more often
#: toxic documents hold one (as a logarithm).
LEAST_COUNT, LEAST_ODDS = 3, 2.0
#: Lengths of stems.
STEMS = range(4, 9)
#: Letters of the longest words whose deletions are compared before the trie is walked.
LONG = 16
#: Words before and after a hit that are its context.
NEAR = 4
#: Words without a match that a worker remembers: these, and as many older ones.
MEMORY = 200_000
#: Words of texts that are matched together, and of a length that are hashed together.
TOGETHER, ROWS = 200_000, 4096

WORD = re.compile(r"[^\W_]+")
BETWEEN = re.compile(r"([^\W_]+)")
#: Fixed words of the context windows.
REPORTING = frozenset(
    "said says say called calls quote quoted quotes quoting word words term terms wrote cited "
    "means meaning sagte nannte wort zitat dit appelle mot cite dijo palabra cita".split()
)
ADDRESS = frozenset("you your youre u ur du dein ihr tu ton vous votre tus usted".split())
QUOTES = "\"'`“”‘’«»„‚‹›"

FEATURES = [
    "most_exact", "exact", "exact_entries", "misspelled", "stems", "stem_entries", "stem_share",
    "quoted", "addressed", "words",
]


def edits(length: int) -> int:
    return 0 if length < 4 else 1 if length < 9 else 2


def deletions(words: list[str], most: int) -> np.ndarray:
    """Hashes of words of one length without up to ``most`` (at most two) of their letters:
    a row a word. What is left by deletions are differences of running sums."""
    size = len(words[0])
    codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").reshape(-1, size).astype(np.uint64)
    sums = np.zeros((len(words), size + 1), dtype=np.uint64)
    np.cumsum((codes + np.uint64(1)) * _POWERS[:size], axis=1, out=sums[:, 1:])
    total, out = sums[:, -1:], [sums[:, -1:]]
    if most:
        out.append(sums[:, :-1] + _BACK * (total - sums[:, 1:]))
    if most > 1:
        i, j = np.triu_indices(size, 1)
        out.append(sums[:, i] + _BACK * (sums[:, j] - sums[:, i + 1]) + _BACK_TWO * (total - sums[:, j + 1]))
    return mixed(np.concatenate(out, axis=1))


_BASE = 0x9E3779B97F4A7C15
_BACK, _BACK_TWO = (np.uint64(pow(_BASE, -k, 2**64)) for k in (1, 2))
_POWERS = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(2 * LONG, _BASE, np.uint64)]))


def _by_length(words: Iterable[str]) -> dict[int, list[str]]:
    out: dict[int, list[str]] = {}
    for word in words:
        out.setdefault(len(word), []).append(word)
    return out


def _put(trie: dict, entry: str) -> None:
    for letter in entry:
        trie = trie.setdefault(letter, {})
    trie[""] = entry


class Automaton:
    """Accepts what is within ``most`` edits of a word. A state has, for each number of
    edits, the lengths of the word's prefixes that are so near, as bits."""

    def __init__(self, word: str, most: int):
        self.most, self.end, self.places = most, 1 << len(word), {}
        for i, letter in enumerate(word):
            self.places[letter] = self.places.get(letter, 0) | 1 << i

    def start(self) -> tuple[int, ...]:
        return tuple((2 << n) - 1 for n in range(self.most + 1))

    def step(self, state: tuple[int, ...], letter: str) -> tuple[int, ...] | None:
        """The next state; None if nothing can be accepted any more."""
        same = self.places.get(letter, 0)
        row = [(state[0] & same) << 1]
        for n in range(1, self.most + 1):
            row.append((state[n] & same) << 1 | state[n - 1] | state[n - 1] << 1 | row[n - 1] << 1)
        return tuple(row) if row[-1] & (2 * self.end - 1) else None

    def distance(self, state: tuple[int, ...]) -> int:
        """Edits of what is accepted; more than ``most`` if it is not."""
        return next((n for n, bits in enumerate(state) if bits & self.end), self.most + 1)


@dataclass
class Lexicon:
    """Entries and their weights. Stems end with ``*``."""

    weights: dict[str, float]
    innocent: frozenset[str] = frozenset()

    def __post_init__(self) -> None:
        self.stems = {e[:-1]: w for e, w in self.weights.items() if e.endswith("*")}
        self.heads = frozenset(e[: STEMS[0]] for e in self.stems)
        # also where a stem covers it: edits may lie in the stem
        whole = sorted(e for e in self.weights if not e.endswith("*") and edits(len(e)))
        # a word within n edits of an entry becomes the same as it by at most n deletions in each
        short = _by_length(e for e in whole if len(e) <= LONG + 2)
        self.entries = [e for some in short.values() for e in some]
        self.sizes = np.array([len(e) for e in self.entries], dtype=np.int64)
        parts = [deletions(some[i : i + ROWS], edits(n)) for n, some in short.items() for i in range(0, len(some), ROWS)]
        cut = np.concatenate([p.ravel() for p in parts]) if parts else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(self.entries)), [p.shape[1] for p in parts for _ in p])
        order = np.argsort(cut, kind="stable")
        self.cut, self.owner = cut[order], owner[order]
        self.width = np.uint64(max(16, (32 * len(cut)).bit_length()))  # of 32 bits about one is set
        place = self.cut >> (np.uint64(64) - self.width)
        self.marks = np.zeros(1 << int(self.width) - 3, dtype=np.uint8)
        np.bitwise_or.at(self.marks, place >> np.uint64(3), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))
        # longer words have too many deletions: of an entry cut into three, one part is spelled
        # right, the first in its place, the last at the word's end, or the middle one, moved by
        # at most one
        self.tries: dict[str, dict] = {}
        self.pieces: dict[int, dict[tuple[int, int], set[str]]] = {}
        for entry in whole:
            size = len(entry)
            if size + 2 <= LONG:
                continue
            a, b = size // 3, size * 2 // 3
            for piece in {entry[:a], entry[a:b], entry[b:]}:
                _put(self.tries.setdefault(piece, {}), entry)
            for length in range(max(LONG + 1, size - 2), size + 3):
                own = self.pieces.setdefault(length, {})
                own.setdefault((0, a), set()).add(entry[:a])
                own.setdefault((length - size + b, length), set()).add(entry[b:])
                for move in range(-1, 2):
                    own.setdefault((a + move, b + move), set()).add(entry[a:b])

    def _held(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``hashes`` and the entries they share one with, each pair once."""
        place = hashes >> (np.uint64(64) - self.width)
        row, column = np.nonzero(self.marks[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1)
        some = hashes[row, column]
        first = np.searchsorted(self.cut, some)
        n = np.searchsorted(self.cut, some, side="right") - first
        at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
        pairs = np.unique(np.repeat(row, n) * len(self.entries) + self.owner[at])
        return np.divmod(pairs, max(1, len(self.entries)))

    def _tries_of(self, words: Iterable[str]) -> Iterator[tuple[str, list[dict]]]:
        """The words that may have an entry near, with tries that hold all such entries."""
        for size, some in _by_length(words).items():
            if size > LONG:
                places = self.pieces.get(size, {}).items()
                for word in some:
                    hit = {word[a:b] for (a, b), own in places if word[a:b] in own}
                    if hit:
                        yield word, [self.tries[piece] for piece in hit]
            elif edits(size):
                for i in range(0, len(some), ROWS):
                    row, entry = self._held(deletions(some[i : i + ROWS], edits(size)))
                    # a short entry allows no more edits than it would for itself
                    allowed = np.where(self.sizes[entry] < 9, 1, edits(size))
                    fits = np.abs(self.sizes[entry] - size) <= allowed
                    tries: dict[int, dict] = {}
                    for k, e in zip(row[fits].tolist(), entry[fits].tolist(), strict=True):
                        _put(tries.setdefault(k, {}), self.entries[e])
                    for k, trie in tries.items():
                        yield some[i + k], [trie]

    def near_all(self, words: Iterable[str]) -> Iterator[tuple[str, int, str]]:
        """Word, distance and entry for the words that have an entry near enough: the
        nearest one, of equally near ones the weightiest."""
        for word, tries in self._tries_of(words):
            automaton = Automaton(word, edits(len(word)))
            best, stack = None, [(t, automaton.start()) for t in tries]
            while stack:
                node, state = stack.pop()
                for letter, below in node.items():
                    if letter == "":
                        apart = automaton.distance(state)
                        if apart <= min(automaton.most, edits(len(below))):
                            found = (apart, -self.weights[below], below)
                            best = found if best is None or found < best else best
                    else:
                        after = automaton.step(state, letter)
                        if after is not None:
                            stack.append((below, after))
            if best:
                yield word, best[0], best[2]

    def near(self, word: str) -> tuple[int, str] | None:
        """Distance and entry of the nearest entry of one word, if near enough."""
        return next(((apart, entry) for _, apart, entry in self.near_all([word])), None)

    def match(self, word: str) -> tuple[str, str, float] | None:
        """Kind (exact, misspelled, stem), entry and weight of a word."""
        return self.matches([word]).get(word)

    def matches(self, words: Iterable[str]) -> dict[str, tuple[str, str, float]]:
        """What `match` gives for the words that match."""
        out, others = {}, []
        for word in words:
            if word in self.weights:
                out[word] = "exact", word, self.weights[word]
            elif word[: STEMS[0]] in self.heads:
                found = [(self.stems[word[:n]], -n) for n in STEMS if len(word) >= n and word[:n] in self.stems]
                if found:  # the weightiest, of equals the shortest
                    weight, size = max(found)
                    out[word] = "stem", word[:-size], weight
                else:
                    others.append(word)
            else:
                others.append(word)
        for word, apart, entry in self.near_all(w for w in others if w not in self.innocent):
            out[word] = "misspelled", entry, self.weights[entry] / (1 + apart)
        return out


class Scanner:
    """Features of texts; remembers what words match, and lately seen ones that do not."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.known = lexicon, {}
        self.hits, self.young, self.old = set(), set(), set()

    def _learn(self, words: set[str]) -> None:
        """Match the words that are not remembered."""
        if len(self.young) >= MEMORY:
            self.young, self.old = set(), self.young
        if len(self.known) >= MEMORY:
            self.known, self.hits = {}, set()
        new = words - self.hits - self.young
        again = new & self.old
        new -= again
        found = self.lexicon.matches(new)
        self.known.update(found)
        self.hits.update(found)
        self.young |= again
        self.young |= new - self.hits

    def features(self, text: str) -> list[float]:
        return next(self.features_of([text]))

    def features_of(self, texts: Iterable[str]) -> Iterator[list[float]]:
        """The features of each text. Texts are matched some at a time."""
        held, distinct, size = [], set(), 0
        for text in texts:
            lower = text.lower()
            own = set(words := WORD.findall(lower))
            held.append((lower, len(words), own))
            distinct |= own
            size += len(words)
            if size >= TOGETHER:
                yield from self._features(held, distinct)
                held, distinct, size = [], set(), 0
        yield from self._features(held, distinct)

    def _features(self, held: list, distinct: set[str]) -> Iterator[list[float]]:
        self._learn(distinct)
        for lower, size, own in held:
            yield self._of(lower, size, own & self.hits)

    def _of(self, lower: str, size: int, found: set[str]) -> list[float]:
        between = BETWEEN.split(lower) if found else []
        words, known = between[1::2], self.known
        hits = [(i, known[w]) for i, w in enumerate(words) if w in found]
        out = dict.fromkeys(FEATURES, 0.0)
        exact, stems = set(), set()
        for i, (kind, entry, weight) in hits:
            near = words[max(0, i - NEAR) : i] + words[i + 1 : i + 1 + NEAR]
            before, after = between[2 * i][-1:], between[2 * i + 2][:1]
            marked = before and after and before in QUOTES and after in QUOTES
            if marked or not REPORTING.isdisjoint(near):
                out["quoted"] += weight
                continue
            if not ADDRESS.isdisjoint(near):
                out["addressed"] += weight
            if kind == "exact":
                out["most_exact"] = max(out["most_exact"], weight)
                out["exact"] += weight
                exact.add(entry)
            elif kind == "misspelled":
                out["misspelled"] += weight
            else:
                out["stems"] += weight
                stems.add(entry)
        n = max(1, size)
        out["stem_share"] = 100 * out["stems"] / (n + 20)
        out["exact_entries"], out["stem_entries"] = len(exact), len(stems)
        for name in ("exact", "misspelled", "stems", "quoted", "addressed", "stem_share", "exact_entries", "stem_entries"):
            out[name] = float(np.log1p(out[name]))
        out["words"] = float(np.log1p(size))
        return [out[f] for f in FEATURES]


@dataclass
class Model:
    lexicon: Lexicon
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def scanner(self) -> Scanner:
        """The process's own, which outlives a task where the model was broadcast."""
        if not hasattr(self.lexicon, "scanner"):
            self.lexicon.scanner = Scanner(self.lexicon)
        return self.lexicon.scanner

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, penalty: float = 1e-3) -> tuple:
    """Means, scales, weights and bias, by Newton steps; ``w`` weighs rows."""
    w = w / w.sum()
    mean = w @ x
    scale = np.sqrt(w @ (x - mean) ** 2)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    ridge = np.full(z.shape[1], penalty)
    ridge[-1] = 1e-6
    theta = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ theta, -40, 40)))
        grad = z.T @ (w * (p - y)) + ridge * theta
        hess = (z * (w * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + np.diag(ridge)
        step = np.linalg.solve(hess, grad)
        theta -= step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, theta[:-1], float(theta[-1])


def _terms(text: str) -> set[str]:
    words = set(WORD.findall(text.lower()))
    return words | {f"{w[:n]}*" for w in words for n in STEMS if len(w) >= n}


def _entries(picked: dict[str, tuple[int, int, float]]) -> dict[str, float]:
    """Weights of the ``picked`` terms (clean, toxic, weight), in the order of the terms.

    A stem is left out if a shorter one is in the same documents: that one has its weight,
    and fits all words that it fits.
    """
    stems = {t[:-1]: v for t, v in picked.items() if t.endswith("*")}
    more = {f"{t}*" for t, v in stems.items() if any(stems.get(t[:n]) == v for n in STEMS if n < len(t))}
    return {t: picked[t][2] for t in sorted(picked) if t not in more}


def _texts(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) covers.

    Labels other than 0 and 1 are left out. A class of more than MOST_ROWS rows is
    sampled by a hash of doc_id and weighed by the inverse of its share; so few ids are
    broadcast. Without toxic documents every text scores 0 or nearly so.
    """
    named = labels.where("toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    n = {r[0]: r[1] for r in named.groupBy("label").count().collect()}
    share = {c: min(1.0, MOST_ROWS / n[c]) if n.get(c) else 1.0 for c in (0, 1)}
    kept = F.when(F.col("label") == 1, F.lit(share[1])).otherwise(F.lit(share[0]))
    place = F.pmod(F.xxhash64(F.lit(4), "doc_id"), F.lit(1 << 30))
    chosen = named.where(place < kept * (1 << 30)).withColumn("half", F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(2)))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label", "half")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in slices(batches):
            for text, label in zip(_texts(batch.column("text")), batch.column("label").to_pylist(), strict=True):
                held[label].update(_terms(text))
                if len(held[0]) + len(held[1]) > 500_000:
                    yield rows_from(held)
        yield rows_from(held)

    def rows_from(held: tuple[Counter, Counter]) -> pa.RecordBatch:
        terms = list(held[0].keys() | held[1].keys())
        out = {"term": terms, "clean": [held[0][t] for t in terms], "toxic": [held[1][t] for t in terms]}
        held[0].clear()
        held[1].clear()
        kinds = {"term": pa.string(), "clean": pa.int64(), "toxic": pa.int64()}
        return pa.RecordBatch.from_arrays([pa.array(out[k], t) for k, t in kinds.items()], list(kinds))

    sizes = {(r[0], r[1]): r[2] for r in chosen.groupBy("label", "half").count().collect()}
    toxic, clean = sizes.get((1, 0), 0), sizes.get((0, 0), 0)
    counts = (
        rows.where("half = 0").mapInArrow(counted, "term string, clean long, toxic long")
        .groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )
    counts = stored(counts.where("clean + toxic > 1"), "toxic-terms")
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    picked = (
        counts.withColumn("odds", odds)
        .where((F.col("odds") >= LEAST_ODDS) & (F.col("toxic") >= LEAST_COUNT))
        .collect()
    )
    lexicon = Lexicon(_entries({r["term"]: (r["clean"], r["toxic"], min(float(r["odds"]), 6.0)) for r in picked}))
    sc = docs.sparkSession.sparkContext
    first = sc.broadcast(lexicon)  # entries: bounded by the sampled rows' texts

    def innocent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = [w for w, _, _ in first.value.near_all(batch.column("term").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.string())], ["term"])

    ordinary = counts.where((F.col("clean") > 0) & ~F.endswith(F.col("term"), F.lit("*"))).where(odds < LEAST_ODDS)
    found = ordinary.select("term").mapInArrow(innocent, "term string").collect()
    lexicon = Lexicon(lexicon.weights, frozenset(r["term"] for r in found))

    second = sc.broadcast(lexicon)

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(second.value)
        for batch in slices(batches):
            got = list(scanner.features_of(_texts(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(got, pa.list_(pa.float64()))], ["label", "x"])

    table = rows.where("half = 1").select("text", "label").mapInArrow(seen, "label int, x array<double>").collect()
    x = np.array([r["x"] for r in table]).reshape(-1, len(FEATURES))
    y = np.array([r["label"] for r in table], dtype=np.float64)
    if not len(x) or y.min() == y.max():
        bias = -10.0 if not len(x) or y[0] == 0 else 10.0
        return Model(lexicon, np.zeros(len(FEATURES)), np.ones(len(FEATURES)), np.zeros(len(FEATURES)), bias)
    order = np.lexsort([*x.T, y])
    return Model(lexicon, *logistic(x[order], y[order], np.where(y[order] == 1, 1 / share[1], 1 / share[0])))


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name``: how likely label 1 is. A column of that name is replaced.

    A null text scores as an empty one; equal texts score alike; no rows give no rows.
    """
    docs = docs.drop(name)
    names = [*docs.columns, name]
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])

    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = shared.value.scanner()
        for batch in slices(batches):
            x = np.array(list(scanner.features_of(_texts(batch.column("text"))))).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.scores(x))], names)

    return docs.mapInArrow(scored, schema)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(remainder(4) != 2)
    return score(docs, train(docs, labels)).select(
        "doc_id", (remainder(4) == 2).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


QUERIES = {"op4_toxicity": op4_toxicity}
ORACLES: dict[str, str] = {}
