"""Operator 4: line dedup by winnowing over line hashes.

A document is its sequence of lines with words, each normalised (lower case,
blanks collapsed) and hashed.  Grams are the shortest runs of lines with
``min_words / 2`` words; of the grams inside each window of ``min_words``
words the one with the smallest hash is selected, so any repeated run of
that many words shares a selected gram: the fingerprint.  Fingerprints found
at two places or more are joined to the windows around them, a match is
extended to ``min_words`` words forwards from its first and backwards from
its last line, compared by 128-bit hashes, and every line of a run that
occurred before is deleted; the first occurrence, by id and line, stays.
Occurrences are compared with the first one only, so a hot passage costs one
row per occurrence.

Defined results: a null text stays null; an empty text stays empty; a text
all of whose lines repeat becomes empty.  Rows that agree in id and text are
one document and get one result; rows that agree in id only are different
documents.  A null id comes before all others.  A result column replaces an
input column of the same name; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlane.llm.base import appended, chunks, texts_of, without, written

MIN_WORDS = 50


def normalised(text: str) -> tuple[list[int], list[bytes], np.ndarray]:
    """Of the lines with words: number, hash (16 bytes) and words."""
    at, hashes, words = [], [], []
    for i, line in enumerate(text.encode("utf-8", "surrogatepass").lower().split(b"\n")):
        own = line.split()
        if own:
            at.append(i)
            hashes.append(xxhash.xxh3_128_digest(b" ".join(own)))
            words.append(len(own))
    return at, hashes, np.array(words, np.int64)


def windows(text: str, min_words: int) -> list[tuple[int, int, int, int, int, int]]:
    """(first line, last line, key, key, fingerprint, its line) of each
    shortest run of ``min_words`` words forwards from a line, and backwards."""
    at, hashes, words = normalised(text)
    n, total = len(at), np.concatenate([[0], np.cumsum(words)])
    if total[-1] < min_words:
        return []
    joined = b"".join(hashes)
    gram_end = np.searchsorted(total, total[:-1] + max(1, min_words // 2)) - 1
    grams = [xxhash.xxh64_intdigest(joined[16 * i:16 * e + 16]) for i, e in enumerate(gram_end.tolist())]
    ends = np.searchsorted(total, total[:-1] + min_words) - 1
    starts = np.searchsorted(total, total[1:] - min_words, side="right") - 1
    spans = [(0, i, e) for i, e in enumerate(ends.tolist()) if e < n]
    spans += [(1, s, j) for j, s in enumerate(starts.tolist()) if s >= 0]
    out = []
    last_gram = np.searchsorted(gram_end, np.arange(n), side="right").tolist()  # grams ending by a line
    for kind, s, e in spans:
        inside = grams[s:last_gram[e]]
        least = min(inside)
        place = s + len(inside) - 1 - inside[::-1].index(least)
        key = xxhash.xxh3_128_digest(joined[16 * s:16 * e + 16], kind)
        hi, lo = np.frombuffer(key, "<i8").tolist()
        out.append((at[s], at[e], hi, lo, least - (1 << 63), at[place]))
    return out


def all_windows(docs: DataFrame, min_words: int, id: str, text: str) -> DataFrame:
    """(id, body, first, last, hi, lo, print, at) over all documents."""
    rows = docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("body"), F.col(text).alias("text")).where(
        F.col("text").isNotNull())
    ints, longs = ("first", "last", "at"), ("hi", "lo", "print")
    order = ("first", "last", "hi", "lo", "print", "at")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            found = [windows(t, min_words) for t in texts_of(b.column(2))]
            rep = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]), pa.int64())
            cols = list(zip(*(w for f in found for w in f))) or [()] * len(order)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(rep), b.column(1).take(rep),
                 *(pa.array(c, pa.int32() if o in ints else pa.int64()) for o, c in zip(order, cols))],
                names=["id", "body", *order])

    kind = docs.schema[id].dataType.simpleString()
    fields = ", ".join(f"{o} {'int' if o in ints else 'long'}" for o in order)
    assert set(order) == {*ints, *longs}
    return rows.mapInArrow(run, f"id {kind}, body long, {fields}")


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, body, spans): first and last lines of runs that occurred before."""
    spark = docs.sparkSession
    every = written(spark, all_windows(docs, min_words, id, text), "line-windows")
    place = F.struct("id", "body", "at")
    again = written(spark, every.groupBy("print").agg(F.min(place).alias("a"), F.max(place).alias("b")).where(
        "a != b").select("print"), "line-prints")
    near = every.join(again, "print", "left_semi").select("id", "body", "first", "last", "hi", "lo")
    near = written(spark, near, "line-matches")
    start = F.struct("id", "body", "first")
    first = written(spark, near.groupBy("hi", "lo").agg(
        F.min(start).alias("a"), F.max(start).alias("b")).where("a != b").select("hi", "lo", "a"), "line-firsts")
    later = near.join(first, ["hi", "lo"]).where(start != F.col("a"))
    return later.groupBy("id", "body").agg(F.collect_set(F.struct("first", "last")).alias("spans"))


def cut(text: str, spans: list[dict]) -> tuple[str, list[int]]:
    """``text`` without the lines of ``spans``, and their numbers; lines
    without words stay unless the whole text goes."""
    lines = text.split("\n")
    gone = np.zeros(len(lines) + 1, np.int64)
    for s in spans:
        gone[s["first"]] += 1
        gone[s["last"] + 1] -= 1
    full = [bool(line.encode("utf-8", "surrogatepass").split()) for line in lines]
    out = [g > 0 and f for g, f in zip(np.cumsum(gone[:-1]).tolist(), full)]
    kept = [line for line, o in zip(lines, out) if not o]
    if not any(f and not o for f, o in zip(full, out)):
        kept = []
    return "\n".join(kept), [i for i, o in enumerate(out) if o]


FIELDS = [T.StructField("n_lines", T.LongType(), False), T.StructField("n_removed", T.LongType(), False),
          T.StructField("removed", T.StringType(), False)]


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated runs of lines cut from ``text``; adds n_lines
    (lines with words), n_removed and removed (line numbers, comma-joined)."""
    spans = written(docs.sparkSession, repeated_lines(docs, min_words, id, text), "line-spans").select(
        F.col("id").alias("_id"), F.col("body").alias("_body"), F.col("spans").alias("_spans"))
    # a shuffle join at every size: the spans grow with the texts
    joined = docs.join(spans.hint("merge"), docs[id].eqNullSafe(F.col("_id")) & (F.xxhash64(docs[text]) == F.col("_body")), "left")
    joined = joined.drop("_id", "_body")
    schema = appended(docs.schema, FIELDS)
    new = [f.name for f in FIELDS]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            texts, spans = b.column(text).to_pylist(), b.column("_spans").to_pylist()
            lines = [sum(1 for x in (t or "").encode("utf-8", "surrogatepass").split(b"\n") if x.split()) for t in texts]
            done = [cut(t, s) if s else (t, []) for t, s in zip(texts, spans)]
            arrays, names = without(b, ["_spans", *new])
            arrays[names.index(text)] = pa.array([t for t, _ in done], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(lines, pa.int64()), pa.array([len(r) for _, r in done], pa.int64()),
                 pa.array([",".join(map(str, r)) for _, r in done], pa.string())], names=[*names, *new])

    return joined.mapInArrow(run, schema)
