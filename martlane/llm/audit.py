"""Operator 13: filter interaction audit by wide packed counters.

Five filters can run in 120 orders of five steps.  What one document does at
all 600 steps follows from its state alone: which filters it fails, and its
two labels.  Each of the 128 states is therefore mapped to one big integer
with 600 x 6 fields (kept, removed, redundant, unique_fails, good_lost and
toxic_lost of every step), each field 0 or 1.  A part's table is the sum of
its documents' integers: tasks add up theirs (state count times integer), the
sums of the tasks are added by part, and one unpacking reads the 600 rows.
A field is as wide as the number of all documents needs, so no field can
carry into the next.

Filters: A: under 200 words; B: 100 * distinct words < 50 * words; C: 100 *
capitals A-Z > 3 * code points; D: any of ``#$%&*|``; E: same text as a row
of a smaller id.  E is found by text hash (SHA-256) in three small steps, so
that a hot text costs a row for each task, part and label only: least id for
each hash and state, least of these for each hash, and all rows but those of
the least id fail.

Defined results: a null text is an empty one (it fails A only, and E beside
another); a null lang is the part of the empty string; a row without an id
neither fails E nor makes another fail it; rows of one id and text stand side
by side (neither is smaller); several label rows of an id count as one that
holds all their ones; a label without an id meets no document.  A very long
text is one row of its task.  An empty table has no parts and gives no rows.
Only the named columns are read, so extra columns never clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlane.llm.base import SPACE_CLASS, Scratch, written

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = [(o, s) for o in range(len(ORDERS)) for s in range(len(FILTERS))]
OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
#: Groups that the tasks' sums of a part are added in first.
SALTS = 16


def outcomes(state: int, order: str, step: int) -> tuple[bool, ...]:
    """What a document of ``state`` (bits 0-4: filters failed, 5: quality, 6:
    toxic) does at ``step`` (from 0) of ``order``."""
    fails = [state >> FILTERS.index(f) & 1 for f in order]
    before, here = any(fails[:step]), bool(fails[step])
    removed = here and not before
    return (not before and not here, removed, here and before, here and sum(fails) == 1,
            removed and bool(state & 32), removed and bool(state & 64))


@lru_cache(maxsize=4)
def packed(width: int) -> list[int]:
    """The big integer of each state, with fields of ``width`` bits."""
    out = []
    for state in range(128):
        number, at = 0, 0
        for o, s in STEPS:
            for hit in outcomes(state, ORDERS[o], s):
                number |= hit << at
                at += width
        out.append(number)
    return out


def unpacked(number: int, width: int) -> list[list[int]]:
    """The six counts of each of the 600 steps."""
    n = len(STEPS) * len(OUTCOMES)
    bits = number.to_bytes((n * width + 7) // 8, "little")
    counts = []
    for k in range(n):
        first, last = k * width, (k + 1) * width
        part = int.from_bytes(bits[first // 8:(last + 7) // 8], "little")
        counts.append(part >> first % 8 & (1 << width) - 1)
    return [counts[i:i + len(OUTCOMES)] for i in range(0, n, len(OUTCOMES))]


def failures(text: Column) -> Column:
    """Bits 0-3: the filters A to D that a whole text fails."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, f"[{SPACE_CLASS}]+"), lambda w: w != "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    bits = (F.size(words) < 200,
            F.size(F.array_distinct(words)) * F.lit(100).cast("long") < F.size(words) * F.lit(50).cast("long"),
            capitals * F.lit(100).cast("long") > F.length(text) * F.lit(3).cast("long"),
            text.rlike("[#$%&*|]"))
    return sum((F.when(b, F.lit(1 << k)).otherwise(F.lit(0)) for k, b in enumerate(bits)), F.lit(0))


def states(docs: DataFrame, labels: DataFrame, scratch: Scratch, id: str = "doc_id", text: str = "text",
           lang: str = "lang") -> DataFrame:
    """(part, state, n): number of documents of each part, state and text."""
    digest = scratch.written(docs.select(
        F.col(id).alias("id"), F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).alias("hash"), failures(F.col(text)).alias("state")), "audit-digest")
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        (F.max((F.col("quality") == 1).cast("int")) * 32).alias("good"),
        (F.max((F.col("toxic") == 1).cast("int")) * 64).alias("bad"))
    known = digest.where("id IS NOT NULL").groupBy("id", "part", "hash", "state").agg(F.count(F.lit(1)).alias("n"))
    known = known.join(marks.hint("merge"), "id", "left").select(
        "id", "part", "hash", (F.col("state") + F.coalesce("good", F.lit(0)) + F.coalesce("bad", F.lit(0))).alias("state"), "n")
    # least id of each text and state with its number of rows, then of each text
    own = known.groupBy("hash", "part", "state").agg(F.sum("n").alias("n"), F.min(F.struct("id", "n")).alias("least"))
    own = scratch.written(own, "audit-texts")
    least = own.groupBy("hash").agg(F.min("least.id").alias("least_id"))
    own = own.join(least.hint("merge"), "hash")
    first = F.when(F.col("least.id") == F.col("least_id"), F.col("least.n")).otherwise(F.lit(0))
    per_text = own.select("part", F.explode(F.array(
        F.struct("state", first.alias("n")),
        F.struct((F.col("state") + 16).alias("state"), (F.col("n") - first).alias("n")))).alias("s")).select("part", "s.*")
    nameless = digest.where("id IS NULL").select("part", "state", F.lit(1).cast("long").alias("n"))
    return per_text.where("n > 0").unionByName(nameless)


def sums(counts: DataFrame, width: int) -> DataFrame:
    """(part, total): the sum of the packed integers of each part, as bytes."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for part, state, n in zip(*(c.to_pylist() for c in b.columns)):
                seen[part, state] += n
        numbers, totals = packed(width), Counter()
        for (part, state), n in seen.items():
            totals[part] += n * numbers[state]
        yield from shown(totals)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter = Counter()
        for b in batches:
            for part, total in zip(b.column("part").to_pylist(), b.column("total").to_pylist()):
                totals[part] += int.from_bytes(total, "little")
        yield from shown(totals)

    def shown(totals: Counter) -> Iterator[pa.RecordBatch]:
        for part, total in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.string()), pa.array([total.to_bytes((total.bit_length() + 7) // 8, "little")], pa.binary())],
                names=["part", "total"])

    kind = "part string, total binary"
    tasks = counts.mapInArrow(pack, kind).withColumn("salt", F.spark_partition_id() % SALTS)
    salted = tasks.repartition(F.col("part"), F.col("salt")).select("part", "total").mapInArrow(add, kind)
    return salted.repartition(F.col("part")).mapInArrow(add, kind)


def audit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """A row for each part, filter order and step (see the module's head)."""
    scratch = Scratch(docs.sparkSession)
    counts = written(docs.sparkSession, states(docs, labels, scratch, id, text, lang), "audit-states")
    scratch.drop()
    width = max(8, int(counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]).bit_length())
    n = len(FILTERS)

    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, total in zip(b.column("part").to_pylist(), b.column("total").to_pylist()):
                rows = unpacked(int.from_bytes(total, "little"), width)
                shapley: Counter = Counter()
                for (o, s), row in zip(STEPS, rows):
                    shapley[ORDERS[o][s]] += row[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(STEPS), pa.string()), pa.array([ORDERS[o] for o, _ in STEPS], pa.string()),
                     pa.array([s + 1 for _, s in STEPS], pa.int32()),
                     *(pa.array([r[k] for r in rows], pa.int64()) for k in range(len(OUTCOMES))),
                     pa.array([shapley[ORDERS[i // n][i % n]] for i in range(len(STEPS))], pa.int64())],
                    names=["part", "filter_order", "step", *OUTCOMES, "shapley"])

    longs = ", ".join(f"{c} long" for c in (*OUTCOMES, "shapley"))
    return sums(counts, width).mapInArrow(unpack, f"part string, filter_order string, step int, {longs}")
