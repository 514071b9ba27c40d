"""Operator 8: toxicity by a weighted lexicon matched with Aho-Corasick.

Texts are folded first: lower case, letters taken apart from their accents and
styles, homoglyphs and digit substitutions to the Latin letters they stand
for, everything that is no letter to a blank.  A sign that can stand for a
letter ('@', '$', '!', '|') is tried as the letter and as a blank, everywhere
and at the start of a word alone; a term found in several of these readings
at one place is one hit.  The lexicon holds word beginnings with a weight each; it is learned from labelled
training rows as log odds of document frequencies, on a bounded sample
(``SAMPLE_ROWS`` rows of each class, the first by a hash of the id); a toxic
document counts once for each different pair of neighbouring words, so copies
of one document do not make its words terms.  A
document's weighted hits, as a sum and in proportion to its length, go
through a logistic fit on the same sample.  Hits inside an exception phrase
do not count: the given ones, and pairs of words learned from the sample in
which a term's odds vanish (in ``LEAST_ROWS`` different surroundings in clean
rows at least, and no likelier in toxic ones).

Defined results: null text is the empty text, whose score is that of a text
without hits; repeated rows repeat their score; without toxic or without
clean training rows the lexicon is empty and every score is the same; very
long texts are matched whole, in time linear in their length; of terms that
tie, the later in the alphabet is kept; an empty table gives an empty one; the
results replace columns of their names.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlane.llm.base import appended, chunks, crc_mod, texts_of, without, written

SAMPLE_ROWS = 3000
TERM_LETTERS = (4, 14)
#: A term occurs in this share of the toxic sample at least, which bounds the
#: number of candidates by terms per document / share.
LEAST_SHARE = 0.005
LEAST_ROWS = 5
LEAST_ODDS = 8.0
#: Least log-likelihood ratio, so that chance does not pass among 10^5
#: candidates.
LEAST_G2 = 25.0
SAME_WORD = 0.9
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "class clown", "pond scum", "sore loser")

# fixed values: digits, signs and letters that stand for a Latin letter
SUBSTITUTES = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l",
    "а": "a", "в": "b", "е": "e", "ё": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
    "у": "y", "х": "x", "ѕ": "s", "і": "i", "ї": "i", "ј": "j", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ɡ": "g", "ӏ": "l",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ł": "l", "ø": "o", "ſ": "s",
}
SIGNS = "@$!|"
STARTING_SIGNS = re.compile(rf"(?<![^\W_])[{SIGNS}]+(?=\w)")
DROPPED = {0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF}


class Folding(dict):
    """Character map for ``str.translate``, filled as characters turn up;
    ``blank`` characters stand for no letter."""

    def __init__(self, blank: str = ""):
        super().__init__({ord(c): " " for c in blank})

    def __missing__(self, code: int):
        apart = unicodedata.normalize("NFKD", chr(code).lower()).lower()
        letters = [SUBSTITUTES.get(c) or (c if c.isalpha() else " ") for c in apart if not unicodedata.combining(c)]
        self[code] = None if code in DROPPED else "".join(letters)
        return self[code]


FOLDING = Folding()
WITHOUT_SIGNS = Folding(SIGNS)


def fold(text: str) -> str:
    return f" {text.translate(FOLDING)} "


def readings(text: str) -> set[str]:
    """The folded text with signs as letters, as blanks, and as blanks at the
    start of a word: equally long, so that places agree."""
    if not any(c in text for c in SIGNS):
        return {fold(text)}
    inside = STARTING_SIGNS.sub(lambda m: " " * len(m[0]), text)
    return {fold(text), fold(inside), f" {text.translate(WITHOUT_SIGNS)} "}


def beginnings(folded: str) -> set[str]:
    """Distinct word beginnings of a folded text."""
    low, high = TERM_LETTERS
    return {w[:k] for w in set(folded.split()) for k in range(low, min(len(w), high) + 1)} | {
        w for w in folded.split() if len(w) == low - 1}


@dataclass(frozen=True)
class Lexicon:
    terms: dict[str, float]
    fit: tuple[float, float, float] = (-3.0, 1.0, 1.0)
    #: Phrases, of which the last word may go on, and learned ones, whole.
    exceptions: tuple[str, ...] = EXCEPTIONS
    learned: tuple[str, ...] = ()

    def matcher(self) -> "Matcher":
        return Matcher(self)


class Matcher:
    def __init__(self, lexicon: Lexicon):
        self.fit = lexicon.fit
        self.automaton = ahocorasick.Automaton()
        for t, w in lexicon.terms.items():
            self.automaton.add_word(" " + t, (len(t), w))
        for shape in [fold(p).rstrip() for p in lexicon.exceptions] + [f" {p} " for p in lexicon.learned]:
            self.automaton.add_word(shape, (len(shape) - 1, None))
        self.automaton.make_automaton()

    def features(self, text: str) -> tuple[float, float]:
        """log(1 + weighted hits), and the same of hits per 1000 letters."""
        found, free = set(), set()
        for folded in readings(text):
            for end, (n, w) in self.automaton.iter(folded):
                (free if w is None else found).add((end - n, end, w))
        if not found:
            return 0.0, 0.0
        free = sorted((start, end) for start, end, _ in free)
        # the farthest end of the phrases that start at a place or before it
        starts, reach = [s for s, _ in free], [-1, *accumulate((e for _, e in free), max)]
        total = math.fsum(w for start, end, w in found if reach[bisect_right(starts, start)] < end)
        return math.log1p(total), math.log1p(1000 * total / len(folded))

    def score(self, text: str) -> float:
        a, b, c = self.fit
        x, y = self.features(text)
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, a + b * x + c * y))))


def odds(a: int, b: int, n_toxic: int, n_clean: int) -> float:
    return (a + 0.5) / (n_toxic + 1) * (n_clean + 1) / (b + 0.5)


def tells(a: int, b: int, n_toxic: int, n_clean: int) -> bool:
    """Do ``a`` toxic and ``b`` clean documents make a term, not chance?"""
    share = (a + b) / (n_toxic + n_clean)
    g2 = 2 * sum(k * math.log(k / (n * share)) for k, n in ((a, n_toxic), (b, n_clean)) if k)
    return odds(a, b, n_toxic, n_clean) >= LEAST_ODDS and g2 >= LEAST_G2


def choose(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Weighted terms out of document frequencies.  Of a word's beginnings
    the longest that still covers it is kept, and no term begins another."""
    good = {t for t in toxic if tells(toxic[t], clean.get(t, 0), n_toxic, n_clean)}
    longer: dict[str, list[str]] = {}
    for t in good:
        longer.setdefault(t[:-1], []).append(t)
    kept: set[str] = set()
    for t in sorted(good, key=lambda t: (len(t), t)):
        if any(t[:k] in kept for k in range(1, len(t))):
            continue
        at = t
        while at in longer:
            best = max(longer[at], key=lambda x: (toxic[x], x))
            if toxic[best] < SAME_WORD * toxic[t]:
                break
            at = best
        kept.add(at)
    covered = [t for t in kept if not any(t[:k] in kept for k in range(1, len(t)))]
    return {t: math.log(odds(toxic[t], clean.get(t, 0), n_toxic, n_clean)) for t in sorted(covered)}


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 50) -> tuple[float, ...]:
    """Ridge logistic fit by Newton steps, both classes weighted alike."""
    x = np.column_stack([np.ones(len(x)), x])
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
        slope = x.T @ (weight * (p - y)) + ridge * beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(curve, slope)
        beta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(map(float, beta))


def training_sample(docs: DataFrame, labels: DataFrame, rows: int, id: str, text: str) -> DataFrame:
    """(toxic, text) of up to ``rows`` labelled rows of each class."""
    known = labels.where(F.col("toxic").isin(0, 1)).where(F.coalesce(crc_mod("doc_id", 3) != 1, F.lit(False)))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    picked = None
    for value in (0, 1):
        some = known.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        picked = some if picked is None else picked.union(some)
    # at most 2 * rows ids of a few bytes: a proven bound
    picked = F.broadcast(picked.select(F.col("doc_id").alias("_id"), F.col("toxic").alias("_toxic")))
    return docs.select(id, text).join(picked, F.col(id) == F.col("_id")).select(
        F.col("_toxic").alias("toxic"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def contexts(texts: DataFrame, among: set[str]) -> dict[str, int]:
    """Between how many different pairs of words each term of ``among`` begins
    a word."""
    low, high = TERM_LETTERS

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[str, int]] = set()
        for b in batches:
            for t in texts_of(b.column(0)):
                words = ["", *fold(t).split(), ""]
                for before, w, after in zip(words, words[1:], words[2:]):
                    for k in range(low - 1, min(len(w), high) + 1):
                        if w[:k] in among:
                            seen.add((w[:k], zlib.crc32(f"{before} {after}".encode())))
        terms, marks = zip(*seen) if seen else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), pa.array(marks, pa.int64())], names=["term", "mark"])

    found = texts.select("text").mapInArrow(run, "term string, mark long").distinct().groupBy("term").count()
    return {r.term: r["count"] for r in found.collect()}


def harmless(texts: DataFrame, terms: set[str], n_toxic: int, n_clean: int) -> tuple[str, ...]:
    """Pairs of neighbouring words, one of them begun by a term, that tell of
    no toxic text; copies of a text show a pair in one surrounding only."""
    low, high = min(map(len, terms), default=0), max(map(len, terms), default=0)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[str, int, int]] = set()
        for b in batches:
            for y, t in zip(b.column(0).to_pylist(), texts_of(b.column(1))):
                words = ["", *fold(t).split(), ""]
                hit = [any(w[:k] in terms for k in range(low, min(len(w), high) + 1)) for w in words]
                for i in range(1, len(words) - 2):
                    if hit[i] or hit[i + 1]:
                        around = f"{words[i - 1]} {words[i + 2]}"
                        seen.add((f"{words[i]} {words[i + 1]}", y, zlib.crc32(around.encode())))
        phrases, ys, marks = zip(*seen) if seen else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(phrases, pa.string()), pa.array(ys, pa.int32()), pa.array(marks, pa.int64())],
            names=["phrase", "toxic", "mark"])

    shown = texts.select("toxic", "text").mapInArrow(run, "phrase string, toxic int, mark long").distinct()
    counts = shown.groupBy("phrase").agg(F.count_if(F.col("toxic") == 1).alias("a"), F.count_if(F.col("toxic") == 0).alias("b"))
    return tuple(sorted(r.phrase for r in counts.where(F.col("b") >= LEAST_ROWS).collect()
                        if odds(r.a, r.b, n_toxic, n_clean) <= 1))


def frequencies(texts: DataFrame, among: set[str] | None, least: int) -> dict[str, int]:
    """In how many texts each word beginning occurs (of ``among``, if given),
    from ``least`` texts on."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, 64):  # bounds what a worker counts at a time
            n: Counter = Counter()
            for t in texts_of(b.column(0)):
                own = beginnings(fold(t))
                n.update(own if among is None else own & among)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["term", "n"])

    counts = texts.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {r.term: r.n for r in counts.where(F.col("n") >= least).collect()}


def learn(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, exceptions: tuple[str, ...] = EXCEPTIONS,
          id: str = "doc_id", text: str = "text") -> Lexicon:
    """Lexicon and logistic fit from the training rows of ``labels``."""
    sample = written(docs.sparkSession, training_sample(docs, labels, rows, id, text), "toxic-sample")
    n = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not n.get(0) or not n.get(1):
        return Lexicon({}, exceptions=exceptions)
    least = max(LEAST_ROWS, math.ceil(LEAST_SHARE * n[1]))
    toxic = frequencies(sample.where("toxic = 1"), None, least)
    clean = frequencies(sample.where("toxic = 0"), set(toxic), 1)
    telling = {t for t in toxic if tells(toxic[t], clean.get(t, 0), n[1], n[0])}
    shown = contexts(sample.where("toxic = 1"), telling)
    toxic = {t: min(toxic[t], k) for t, k in shown.items() if k >= least}
    terms = choose(toxic, clean, n[1], n[0])
    lexicon = Lexicon(terms, exceptions=exceptions, learned=harmless(sample, set(terms), n[1], n[0]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = lexicon.matcher()
        for b in batches:
            found = [matcher.features(t) for t in texts_of(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array([f[k] for f in found], pa.float64()) for k in (0, 1))], names=["y", "a", "b"])

    # bounded by the sample: at most 2 * rows documents
    found = sample.select("toxic", "text").mapInArrow(run, "y int, a double, b double").toPandas()
    fit = logistic(found[["a", "b"]].to_numpy(), found["y"].to_numpy())
    return replace(lexicon, fit=fit)


FIELDS = [T.StructField("score", T.DoubleType(), False), T.StructField("predicted", T.IntegerType(), False)]


def score(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.7, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with its score and whether it reaches the
    threshold."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = lexicon.matcher()
        for b in chunks(batches):
            s = np.array([matcher.score(t) for t in texts_of(b.column(text))], dtype=np.float64)
            arrays, names = without(b, [f.name for f in FIELDS])
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                names=[*names, *(f.name for f in FIELDS)])

    return docs.mapInArrow(run, appended(docs.schema, FIELDS))
