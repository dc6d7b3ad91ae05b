"""Benchmark decontamination: a BM25 index of test items, searched with block-max WAND.

Test items are indexed by their words. Every passage of every training document is a
query: all items whose score reaches a share of what they score against themselves are
retrieved. A retrieved item counts as leaked if the passage really holds it: the word
5-grams of both its question and its answer, or all of it, question and answer, but for
a few words changed, left out or put in, which short items cannot show by 5-grams.

Items are put in classes by length; a class's passages are twice as long as its longest
item may be and overlap by half, so each item lies whole in some passage. Scores are
divided by the item's own, so one threshold serves all items. Items lie in at most 64
blocks. The block maxima of a passage's distinct terms, summed for many passages at
once, bound what any item of a block can score; blocks that cannot reach the threshold
are skipped, and WAND walks the posting lists of the others.

Document frequencies and the mean length are those of all items, counted by Spark, so
no score depends on which items share an index. Indexes are built in tasks, a bounded
size of items each, and stored; the driver holds one at a time on its way to the tasks.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator
from dataclasses import InitVar, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.session import stored

from .text import MARKS, Hasher, hashed, rows_of, signed, slices

K1, B = 1.2, 0.75
#: An item is retrieved at this share of its score against itself.
THRESHOLD = 0.5
#: Shares of the 5-grams found: of the whole item, and of its question and its answer.
OVERLAP, PART_OVERLAP = 0.8, 0.5
GRAM = 5
#: Words changed, left out or put in, as shares: of the whole item, and of its question
#: and its answer.
EDITS, PART_EDITS = 0.15, 0.5
#: Longest item of the first class, in words; each further class has twice that.
SHORTEST_CLASS = 64
#: Blocks of items, at most.
BLOCKS = 64
#: Bytes of item text in an index that is sent to every task; more items make more
#: indexes, which are searched one after another.
INDEX_BYTES = 16 << 20

_HASHER = Hasher(10)


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams of a word sequence, or of the whole of a shorter one."""
    n = min(n, len(words))
    out = np.zeros(len(words) - n + 1 if n else 0, dtype=np.uint64)
    for i in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[i : len(words) - n + 1 + i]
    return out


def edits(item: np.ndarray, words: np.ndarray) -> int:
    """Fewest words to change, leave out or put in to find the item in the passage.

    One step a word of the passage: bits hold how the column of distances rises and falls
    along the item.
    """
    n, places = len(item), {}
    for i, word in enumerate(item.tolist()):
        places[word] = places.get(word, 0) | 1 << i
    every, last = (1 << n) - 1, 1 << n >> 1
    up, down, distance, best = every, 0, n, n
    for word in words.tolist():
        same = places.get(word, 0)
        flat = same | down
        along = ((same & up) + up ^ up) | same
        rise, fall = (down | ~(along | up)) & every, up & along
        distance += bool(rise & last) - bool(fall & last)
        best = min(best, distance)
        rise, fall = rise << 1 & every, fall << 1 & every
        up, down = (fall | ~(flat | rise)) & every, rise & flat
    return best


def parts(text: str) -> tuple[str, str]:
    """Question and answer: cut after the last question mark that has words on both
    sides, or else in the middle."""
    at = text.rfind("?") + 1
    if at and text[:at].strip("? \n\t") and text[at:].strip():
        return text[:at], text[at:]
    words = text.split()
    half = (len(words) + 1) // 2
    return " ".join(words[:half]), " ".join(words[half:])


def _words(text: str) -> np.ndarray:
    got = [h[0] for _, h, _ in hashed([text.lower().encode()], [_HASHER], MARKS)]
    return np.concatenate(got) if got else np.zeros(0, np.uint64)


@dataclass
class Index:
    """Posting lists of one class of items."""

    longest: int
    items: list
    whole: list[np.ndarray]
    question: list[np.ndarray]
    answer: list[np.ndarray]
    counts: InitVar[dict]  # items that hold a word, of all items
    number: InitVar[int]  # all items
    mean: InitVar[float]  # their mean length
    terms: np.ndarray = field(init=False)
    maxima: np.ndarray = field(init=False)  # terms x blocks

    def __post_init__(self, counts: dict, number: int, mean: float) -> None:
        n = len(self.items)
        counted = [np.unique(w, return_counts=True) for w in self.whole]
        self.terms = np.unique(np.concatenate([t for t, _ in counted]))
        at = [np.searchsorted(self.terms, t) for t, _ in counted]
        df = np.array([counts[t] for t in self.terms.tolist()], dtype=np.float64)
        idf = np.log(1 + (number - df + 0.5) / (df + 0.5))
        width = -(-n // BLOCKS)
        self.first = list(range(0, n, width)) + [n]
        self.maxima = np.zeros((len(self.terms), len(self.first) - 1), dtype=np.float32)
        self.postings: list[dict[int, list[tuple[int, float]]]] = [{} for _ in self.first[1:]]
        for i, (own, (_, tf)) in enumerate(zip(at, counted, strict=True)):
            norm = K1 * (1 - B + B * len(self.whole[i]) / mean)
            score = idf[own] * tf * (K1 + 1) / (tf + norm)
            score /= score.sum()
            block = i // width
            self.maxima[own, block] = np.maximum(self.maxima[own, block], score)
            for t, x in zip(own.tolist(), score.tolist(), strict=True):
                self.postings[block].setdefault(t, []).append((i, x))
        self.seen = np.zeros(1 << 20, dtype=bool)
        self.seen[self.terms & np.uint64((1 << 20) - 1)] = True

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """Each word's term number, or -1."""
        out = np.full(len(words), -1, dtype=np.int64)
        may = np.flatnonzero(self.seen[words & np.uint64((1 << 20) - 1)])
        at = np.minimum(np.searchsorted(self.terms, words[may]), len(self.terms) - 1)
        out[may] = np.where(self.terms[at] == words[may], at, -1)
        return out

    def retrieve(self, block: int, terms: list[int], least: float) -> list[tuple[int, float]]:
        """Every item of a block that scores ``least`` or more, by WAND."""
        lists, tops = self.postings[block], self.maxima[:, block]
        cursors = [[0, lists[t], float(tops[t])] for t in terms if t in lists]
        out = []
        while cursors:
            cursors.sort(key=lambda c: c[1][c[0]][0])
            bound, item = 0.0, None
            for at, postings, top in cursors:
                bound += top
                if bound >= least:
                    item = postings[at][0]
                    break
            if item is None:  # what is left of all lists together can't reach it
                break
            score, left = 0.0, []
            for at, postings, top in cursors:
                while at < len(postings) and postings[at][0] < item:
                    at += 1
                if at < len(postings) and postings[at][0] == item:
                    score += postings[at][1]
                    at += 1
                if at < len(postings):
                    left.append([at, postings, top])
            if score >= least:
                out.append((item, score))
            cursors = left
        return out

    def passages(self, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of documents whose words begin at ``offsets``: the first passage of each, with
        the end as the last, and each passage's first word."""
        sizes = np.diff(offsets)
        n = np.maximum(-(-sizes // self.longest) - 1, 1)
        bases = np.concatenate([[0], np.cumsum(n)])
        return bases, np.repeat(offsets[:-1] - bases[:-1] * self.longest, n) + np.arange(bases[-1]) * self.longest

    def leaks(self, words: np.ndarray, offsets: np.ndarray) -> Iterator[tuple]:
        """Document, item, first word of the passage, score and overlaps of each leak."""
        bases, starts = self.passages(offsets)
        number = self.numbers(words)
        at = np.flatnonzero(number >= 0)
        doc = np.searchsorted(offsets, at, side="right") - 1
        part = (at - offsets[doc]) // self.longest
        last = bases[doc + 1] - bases[doc] - 1
        terms = number[at]
        own = [
            (bases[doc[x]] + part[x] - back) * len(self.terms) + terms[x]
            for back, x in ((0, part <= last), (1, part > 0))
        ]
        keys = np.unique(np.concatenate(own))
        passage, term = np.divmod(keys, len(self.terms))
        heads = np.flatnonzero(np.diff(passage, prepend=-1))
        if not len(heads):
            return
        ends = np.append(heads[1:], len(keys))
        least = THRESHOLD - 1e-6  # sums of floats
        for a in range(0, len(heads), 1024):  # bounds memory
            some = heads[a : a + 1024]
            rows = slice(some[0], ends[min(a + 1024, len(heads)) - 1])
            bound = np.add.reduceat(self.maxima[term[rows]], some - some[0], axis=0)
            near, blocks = np.nonzero(bound >= least)
            for k, block in zip((near + a).tolist(), blocks.tolist(), strict=True):
                p = int(passage[heads[k]])
                for item, score in self.retrieve(block, term[heads[k] : ends[k]].tolist(), least):
                    d = int(np.searchsorted(bases, p, side="right")) - 1
                    first = int(starts[p])
                    passage_words = words[first : min(first + 2 * self.longest, offsets[d + 1])]
                    shares = self._shares(passage_words, item)
                    whole = shares[0] >= OVERLAP and min(shares[1:]) >= PART_OVERLAP
                    if whole or self._edited(passage_words, item):
                        yield d, item, first - int(offsets[d]), score, *shares

    def _shares(self, words: np.ndarray, item: int) -> list[float]:
        """Shares of the 5-grams of the item, its question and its answer in a passage."""
        out = []
        for part in (self.whole[item], self.question[item], self.answer[item]):
            own = np.unique(grams(part, GRAM))
            held = grams(words, min(GRAM, len(part)))
            out.append(float(np.isin(own, held).mean()) if len(own) else 1.0)
        return out

    def _edited(self, words: np.ndarray, item: int) -> bool:
        """Whether a passage holds the item but for a few words."""
        whole, least = self.whole[item], 1 - EDITS
        if np.isin(whole, words).mean() < least or edits(whole, words) > EDITS * len(whole):
            return False
        return all(edits(p, words) <= PART_EDITS * len(p) for p in (self.question[item], self.answer[item]))


def build(
    items: list[tuple[int, str | None]], counts: dict | None = None, number: int = 0, mean: float = 0.0
) -> list[Index]:
    """One index for each class of lengths; items without words are in none.

    ``counts`` says how many of ``number`` items, of ``mean`` length, hold a word; None
    takes ``items`` for all there are.
    """
    classes: dict[int, list] = {}
    for item, text in sorted(items, key=lambda x: (x[0] is None, x[0] or 0, x[1] or "")):
        whole = _words(text or "")
        if len(whole):
            longest = SHORTEST_CLASS
            while longest < len(whole):
                longest *= 2
            first, second = (_words(p) for p in parts(text))
            classes.setdefault(longest, []).append((item, whole, first, second))
    if counts is None:
        own = [whole for rows in classes.values() for _, whole, _, _ in rows]
        counts = Counter(w for words in own for w in np.unique(words).tolist())
        number, mean = len(own), sum(map(len, own)) / max(1, len(own))
    known = (counts, number, mean)
    return [Index(n, *map(list, zip(*rows, strict=True)), *known) for n, rows in sorted(classes.items())]


def _indexes(items: DataFrame) -> Iterator[Broadcast]:
    """Indexes of bounded size over all of ``items`` (item_id, text), one at a time."""
    spark = items.sparkSession
    whole = isinstance(items.schema["item_id"].dataType, T.IntegralType)
    items = items.select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(int(size // INDEX_BYTES) + 1))
    items = stored(items.withColumn("shard", shard), "leak-items")

    def distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = [_words(t or "") for t in batch.column("text").to_pylist()]
            own = [np.unique(w) for w in words]
            at = np.repeat(np.arange(len(own)), [len(w) for w in own])
            terms = pa.array(signed(np.concatenate(own)))
            lengths = pa.array(np.array([len(w) for w in words], dtype=np.int64)).take(pa.array(at))
            first = pa.array(np.diff(at, prepend=-1) > 0)
            shards = batch.column("shard").take(pa.array(at))
            yield pa.RecordBatch.from_arrays([shards, terms, lengths, first], ["shard", "term", "size", "first"])

    held = stored(items.mapInArrow(distinct_words, "shard long, term long, size long, first boolean"), "leak-words")
    total = held.where("first").agg(F.count("*").alias("n"), F.sum("size").alias("size")).first()
    if not total["n"]:
        return
    number, mean = total["n"], total["size"] / total["n"]
    frequency = held.groupBy("term").agg(F.count("*").alias("df"))
    needed = held.select(F.col("shard").alias("of"), "term").distinct().join(frequency, "term")

    def index(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        counts = dict(zip(known["term"].to_numpy().view(np.uint64).tolist(), known["df"].tolist(), strict=True))
        chosen = [(int(i) if whole and i is not None else i, t) for i, t in zip(rows["item_id"], rows["text"], strict=True)]
        built = build(chosen, counts, number, mean) if len(rows) else []
        out = [(int(rows["shard"].iloc[0]), pickle.dumps(built))] if built else []
        return pd.DataFrame(out, columns=["shard", "index"])

    made = items.groupBy("shard").cogroup(needed.groupBy("of")).applyInPandas(index, "shard long, index binary")
    made = stored(made, "leak-indexes")
    for (number_of,) in made.select("shard").orderBy("shard").collect():  # a number for each INDEX_BYTES
        yield spark.sparkContext.broadcast(pickle.loads(made.where(F.col("shard") == number_of).first()["index"]))


def _of_batch(texts: list[bytes], indexes: list[Index]) -> list[list[tuple]]:
    """Leaks of each text: item, start, score, overlap, question, answer. Of several
    passages with the same item, the best-scored and then the first one."""
    lower = [x.lower() if x.isascii() else x.decode("utf-8", "replace").lower().encode() for x in texts]
    found: list[dict] = [{} for _ in texts]
    for first, (words,), offsets in hashed(lower, [_HASHER], MARKS):
        for index in indexes:
            for d, item, *row in index.leaks(words, offsets):
                best, own = found[first + d], index.items[item]
                if own not in best or row[1] > best[own][1]:
                    best[own] = row
    return [[(k, *x[k]) for k in sorted(x, key=str)] for x in found]


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, start (word), score, overlap, question, answer of each leaked item.

    Of several passages with the same item the best-scored one is told. Null and empty
    texts, and items without words, leak nothing; a repeated row leaks again; a document
    without leaks has no row. Words are runs of letters and digits, lower-cased.
    """
    whole = isinstance(items.schema["item_id"].dataType, T.IntegralType)
    kind = T.LongType() if whole else T.StringType()
    items = items.withColumn("item_id", F.col("item_id").cast(kind))
    arrow = pa.int64() if whole else pa.string()
    fields = [docs.schema["doc_id"], T.StructField("item_id", kind),
              T.StructField("start", T.LongType()),
              *[T.StructField(n, T.DoubleType()) for n in ("score", "overlap", "question", "answer")]]
    schema = T.StructType(fields)
    names = [f.name for f in fields]
    out = docs.sparkSession.createDataFrame([], schema)
    for indexes in _indexes(items):

        def search(batches: Iterator[pa.RecordBatch], indexes=indexes) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                got = _of_batch(rows_of(batch.column("text")), indexes.value)
                at = pa.array([i for i, rows in enumerate(got) for _ in rows], pa.int64())
                flat = [r for rows in got for r in rows]
                kinds = (arrow, pa.int64(), *[pa.float64()] * 4)
                columns = [pa.array([r[c] for r in flat], k) for c, k in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), *columns], names)

        out = out.unionByName(docs.select("doc_id", "text").mapInArrow(search, schema))
    return out


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text leaks no item; null and empty texts stay."""
    for indexes in _indexes(items):

        def keep(batches: Iterator[pa.RecordBatch], indexes=indexes) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                got = _of_batch(rows_of(batch.column("text")), indexes.value)
                yield batch.filter(pa.array([not rows for rows in got], pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {"op10_decontaminate": op10_decontaminate}
ORACLES: dict[str, str] = {}
