"""Operator 1: secret scans by dictionary-primed compression novelty.

Base patterns find secrets of known shape.  Beyond them, every token of 8
characters or more that follows a sensitive word is a candidate: its marginal
size is what a zstandard compressor, primed with the corpus's identifiers,
needs for the surrounding text with the candidate beyond what it needs without
it, compared with what random text of the candidate's length and alphabet
needs there.  Names and repeats cost next to nothing; what costs about as much
as random text is reported as ``novel``, unless it has no digit and is made of
words that are common in the corpus.

The identifier dictionary is counted over all documents (names that are
assigned to), and the most frequent ``DICTIONARY_WORDS`` of them prime the
compressor: a bounded broadcast, the tail only primes less.  So are common
words: the ``COMMON_WORDS`` that most texts hold tell plain words, the first
``PRIMING_WORDS`` prime.  A secret of letters in one case, without digits,
that is as common as that counts as a word.

Defined results: null text is the empty text, without spans; repeated rows
repeat their result; spans are in code points, end exclusive; spans that start
at one place are ordered by kind; very long texts are scanned whole, in time
linear in their length but for the logarithm of their spans; an empty table
gives an empty one; the results replace columns of their names.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlane.llm.base import Scratch, appended, chunks, texts_of, without

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
# A run shorter than the least length fails as a whole, so only long ones
# need to match.
ACCESS = re.compile("AKIA[A-Z0-9]{12,}")
HEX = re.compile("[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "novel")

#: Words after which a token is a candidate, and how near it must be.  They
#: are whole words or whole parts of names: 'authToken', 'SESSION_ID', but not
#: 'author' or 'SESSIONS2'.
WORDS = ("passw(?:or)?d|pwd|passphrase|secret|token|api_?key|key|credential|o?auth|authorization|authentication"
         "|bearer|private|cert|certificate|signature|session|cookie|jwt")
SENSITIVE = re.compile(
    rf"(?:(?<![A-Za-z])|(?<=[a-z])(?=[A-Z]))(?i:{WORDS})s?(?![a-z])(?!(?<=[A-Z])[A-Z])", re.A)
REACH = 40
CANDIDATE = re.compile(r"(?<![@A-Za-z0-9+/_=~.-])[A-Za-z0-9+/_=~.-]{8,}")
#: A value inside a candidate: the name before '=' is context, '=' at the end
#: is padding.
PART = re.compile(r"[^=]{8,}(?:=+\Z)?")
# '=' at the end of a string is padding of a value, which must not prime.
IDENTIFIER = r"([A-Za-z_][A-Za-z0-9_]{2,})(?:\x20*\(|\x20+=(?!=)|=(?![=\s]|$|[\x22\x27](?:[\s,;)}\]]|$)))"
DICTIONARY_WORDS = 2000
#: The most frequent words, by texts that hold them, of so many letters.
COMMON_WORDS = 50_000
COMMON_LETTERS = 4
#: They prime the compressor too, so many of them.
PRIMING_WORDS = 1000
#: Part of a token's letters that has to be in common words to make it plain.
PLAIN = 0.75
COUNTED_WORDS = 200_000
SURROUNDINGS = 512
#: Part of the marginal bytes of random text over its own alphabet from which
#: a candidate is incompressible.
NOVELTY = 0.75
#: Sets of symbols an alphabet is made of.
SYMBOLS = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "+/", "_-.~", "=")
#: So many random characters are measured for comparison, one text at least.
RANDOM_CHARS = 128


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, index of the kind, end) by start, then kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


#: Words in a token: of one case, or begun by a capital.
NAME_PART = re.compile("[A-Z]?[a-z]+|[A-Z]+")


class Novelty:
    """Marginal compressed size under one dictionary of identifiers and common
    words (most common first)."""

    def __init__(self, identifiers: Iterable[str], common: Iterable[str] = ()):
        common = list(common)
        self.common = frozenset(common)
        words = "\n".join([*common[:PRIMING_WORDS][::-1], *identifiers]).encode()
        primed = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(words) > 8 else None
        self.compressor = zstandard.ZstdCompressor(level=9, dict_data=primed, write_content_size=False)

    def size(self, data: bytes) -> int:
        return len(self.compressor.compress(data))

    def plain(self, token: str) -> bool:
        """Is the token made of common words, and no digits?"""
        if any(c.isdigit() for c in token):
            return False
        parts = NAME_PART.findall(token)
        known = sum(len(p) for p in parts if p.lower() in self.common)
        return known > 0 and known >= PLAIN * sum(map(len, parts))

    def rate(self, text: str, start: int, end: int) -> float:
        """Marginal size of ``text[start:end]`` after its surroundings on both
        sides, as a part of that of random text over its alphabet.  Copies of it there (as a whole, not
        inside longer words) are cut, so each copy is judged by itself."""
        own = text[start:end]
        near = text[end:end + SURROUNDINGS] + "\n" + text[max(0, start - SURROUNDINGS):start]
        if own in near:
            near = re.sub(rf"(?<![A-Za-z0-9_]){re.escape(own)}(?![A-Za-z0-9_])", "", near)
        near_b = near.encode("utf-8", "replace")
        alone = self.size(near_b)
        alphabet = "".join(x for x in SYMBOLS if not set(x).isdisjoint(own))
        rnd = random.Random(own)
        times = max(1, RANDOM_CHARS // len(own))
        other = sum(self.size(near_b + "".join(rnd.choices(alphabet, k=len(own))).encode()) - alone for _ in range(times))
        return (self.size(near_b + own.encode()) - alone) * times / max(1, other)

    def spans(self, text: str, base: list[tuple[int, int, int]], least: float) -> list[tuple[int, int, int]]:
        """Novel candidates outside the base spans: the values of a candidate
        with '=', the whole of it if none of them is novel.  A string reported
        once, as a base span's value too, is reported wherever it is a
        candidate."""
        starts, reach = [s for s, _, _ in base], [*accumulate((e for _, _, e in base), max)]  # base is sorted

        def candidate(near: int, start: int, end: int) -> bool:
            before = bisect_left(starts, end)  # base spans that start before the end; the farthest end of them
            return (SENSITIVE.search(text, max(0, near - REACH), start) is not None
                    and not (before and reach[before - 1] > start))

        tried = []
        for m in CANDIDATE.finditer(text):
            values = []
            for v in PART.finditer(m[0]):
                # the name's start, so that a long name is seen whole
                name = m[0].rfind("=", 0, max(0, v.start() - 1)) + 1
                if candidate(m.start() + name, m.start() + v.start(), m.start() + v.end()):
                    values.append((m.start() + v.start(), m.start() + v.end()))
            whole = [m.span()] if "=" in m[0] and candidate(m.start(), *m.span()) else []
            if values or whole:
                tried.append((values, whole))
        if not tried:
            return []
        known = {ASSIGN.match(text, s)[2] if k == 0 else text[s:e] for s, k, e in base}
        novel = {}
        for spans in tried:
            for s, e in [*spans[0], *spans[1]]:
                novel[s, e] = text[s:e] in known or not self.plain(text[s:e]) and self.rate(text, s, e) >= least
                if novel[s, e] and (s, e) in spans[0]:
                    known.add(text[s:e])
        found = []
        for values, whole in tried:
            out = [x for x in values if novel[x] or text[slice(*x)] in known]
            out = out or [x for x in whole if novel[x] or text[slice(*x)] in known]
            found += [(s, 3, e) for s, e in out]
        return found


def identifiers(docs: DataFrame, top: int = DICTIONARY_WORDS, text: str = "text") -> list[str]:
    """The ``top`` names most often assigned to or called, over all texts
    (ties by name), rarest first: a compressor reaches the end of its
    dictionary most cheaply."""
    names = docs.select(F.explode(F.expr(f"regexp_extract_all(`{text}`, r'{IDENTIFIER}', 1)")).alias("name"))
    best = names.groupBy("name").count().orderBy(F.desc("count"), "name").limit(top)
    return [r.name for r in best.collect()][::-1]


def common_words(docs: DataFrame, top: int = COMMON_WORDS, text: str = "text") -> list[str]:
    """Up to ``top`` words of ``COMMON_LETTERS`` letters or more that most texts
    hold, two at least, most common first (ties by word): all words from a
    frequency on that leaves no more of them."""
    word = re.compile(rf"(?<![A-Za-z0-9])[A-Za-z]{{{COMMON_LETTERS},}}(?![A-Za-z0-9])")

    def batch(n: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()
        for b in chunks(batches, 64):
            for t in texts_of(b.column(0)):
                n.update({w.lower() for w in set(word.findall(t))})
            if len(n) >= COUNTED_WORDS:  # bounds what a worker counts at a time
                yield batch(n)
                n = Counter()
        yield batch(n)

    counts = docs.select(F.col(text)).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    # steps of 1.6 % of the frequency: some 2,000 rows at most, whatever the vocabulary
    step = F.floor(64 * F.log("n")).alias("step")
    scratch = Scratch(docs.sparkSession)
    counts = scratch.written(counts.where(F.col("n") > 1), "words")
    sizes = {r.step: r["count"] for r in counts.groupBy(step).count().collect()}
    kept = 0
    for least in sorted(sizes, reverse=True):
        if kept + sizes[least] > top:
            break
        kept, floor = kept + sizes[least], least
    # ``kept`` words, ``top`` at most: a proven bound
    found = counts.where(step >= floor).collect() if kept else []
    scratch.drop()
    return [r.word for r in sorted(found, key=lambda r: (-r.n, r.word))]


FIELDS = [T.StructField("n_assign", T.LongType(), False), T.StructField("n_access", T.LongType(), False),
          T.StructField("n_hex", T.LongType(), False), T.StructField("n_novel", T.LongType(), False),
          T.StructField("base_sha256", T.StringType(), False), T.StructField("spans", T.StringType(), False)]


def written_spans(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan_secrets(docs: DataFrame, novelty: float = NOVELTY, dictionary: int = DICTIONARY_WORDS,
                 text: str = "text") -> DataFrame:
    """Every row of ``docs`` with counts by kind, the hash of its base spans
    and all spans (``kind:start:end``, comma-joined)."""
    words, common = identifiers(docs, dictionary, text), common_words(docs, text=text)
    schema = appended(docs.schema, FIELDS)
    new = [f.name for f in FIELDS]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Novelty(words, common)
        for b in chunks(batches):
            rows = []
            for t in texts_of(b.column(text)):
                base = base_spans(t)
                spans = sorted(base + model.spans(t, base, novelty))
                counts = [sum(k == i for _, k, _ in spans) for i in range(len(KINDS))]
                digest = hashlib.sha256(written_spans(base).encode()).hexdigest()
                rows.append((*counts, digest, written_spans(spans)))
            cols = list(zip(*rows)) if rows else [()] * len(new)
            out = [pa.array(c, pa.int64() if i < 4 else pa.string()) for i, c in enumerate(cols)]
            arrays, names = without(b, new)
            yield pa.RecordBatch.from_arrays([*arrays, *out], names=[*names, *new])

    return docs.mapInArrow(run, schema)
