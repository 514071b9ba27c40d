"""Operator 6: SimHash near-duplicates by multi-index hashing.

A fingerprint is the bitwise majority over the XXH64 values of a text's word
shingles.  Equal fingerprints are merged first (pre-aggregated, so a hot
group of copies is one row).  The 64 bits are cut into segments, few enough
that two fingerprints within the distance differ by one bit at most in one of
them.  Each segment has a table keyed by its value; a fingerprint enumerates
the Hamming ball of radius 0 or 1 around its own value, fetches the members
of those keys and verifies the distance over all 64 bits.

A value that many fingerprints share (more than ``BUCKET``) isn't fetched:
its members are dealt again by the value and a segment of the bits that are
left, with what the ball has left of the distance, until no key is too
frequent.  That is the same search in fewer bits, so nothing is lost and no
fetch returns more than ``BUCKET`` members, however many near copies there
are; a key of all bits has one member.

Defined results: null text is the empty text; a text without words has the
fingerprint zero, linked like any other; texts of any length are hashed whole.
Rows with a null id belong to their group but never name it; a group of such
rows only has a null component.  Repeated rows share a component, ties have
one smallest id.  An empty table gives no rows.  Other columns of the input
take no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlane.llm.base import Scratch, chunks, texts_of, written

SEED = 42
BITS = 64
MAX_BITS = 8
#: Members that one key's fetch may return; beyond it the key is refined.
BUCKET = 64
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 of every ``size``-word shingle, repeats included; a text of
    fewer words is one shingle, a text of none has no hash."""
    joined = b" ".join(text.encode("utf-8", "surrogatepass").lower().split())
    if not joined:
        return np.empty(0, np.uint64)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    h = xxhash.xxh64_intdigest
    if len(gaps) + 1 <= size:
        return np.array([h(joined, SEED)], np.uint64)
    starts = [0, *(gaps + 1).tolist()]
    ends = [*gaps.tolist(), len(joined)][size - 1:]
    return np.fromiter((h(joined[s:e], SEED) for s, e in zip(starts, ends)), np.uint64, len(ends))


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half of ``hashes``."""
    n = len(hashes)
    if not n:
        return 0
    lanes = hashes.astype("<u8").view(np.uint8).reshape(n, 8)
    counts = np.concatenate([np.bincount(lanes[:, k], minlength=256) @ BYTE_BITS for k in range(8)])
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 3, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp): the fingerprint of each row as a signed long."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            fps = np.array([fingerprint(shingle_hashes(t, size)) for t in texts_of(b.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=[id, "fp"])

    schema = T.StructType([T.StructField(id, docs.schema[id].dataType), T.StructField("fp", T.LongType())])
    return docs.select(id, text).mapInArrow(run, schema)


def segments(mask: int, count: int) -> list[list[int]]:
    """The bits outside ``mask``, cut into ``count`` runs (fewer if there are
    fewer bits)."""
    rest = [bit for bit in range(BITS) if not mask >> bit & 1]
    return [run.tolist() for run in np.array_split(rest, min(count, len(rest)))]


def signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


STEP = "mask long, finer long, segment int, segments int, flip long"


def refined(df: DataFrame, masks: list[int], count: int) -> DataFrame:
    """``df`` (columns mask, fp and others) with a row for each way to refine
    a key over the bits of its ``mask``: for each segment of the other bits
    the mask with it, and each flip of one of its bits or none."""
    rows = []
    for mask in masks:
        runs = segments(mask, count)
        for segment, run in enumerate(runs):
            finer = mask | sum(1 << bit for bit in run)
            rows += [(signed(mask), signed(finer), segment, len(runs), signed(flip))
                     for flip in [0, *(1 << bit for bit in run)]]
    if masks == [0]:  # the first level: every row has the same steps
        fields = [f.strip().split() for f in STEP.split(",")][1:]
        literals = F.array(*[F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row[1:], fields)]) for row in rows])
        return df.select("*", F.inline(literals))
    # sized by the bits, not by the data
    return df.join(F.broadcast(df.sparkSession.createDataFrame(rows, STEP)), "mask")


def links(fps: DataFrame, max_bits: int) -> DataFrame:
    """(a, b), a > b: all pairs of ``fps`` (distinct column fp) within
    ``max_bits`` (0 to 8) differing bits.  A frequent key asks once for each
    finer one, so beyond 3 bits, where there are 3 to 5 segments, dense groups
    cost that many times more at each level."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"max_bits is 0 to {MAX_BITS}")
    spark, scratch = fps.sparkSession, Scratch(fps.sparkSession)
    if max_bits == 0:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where(F.lit(False))
    # so many segments that one of them differs by one bit at most
    count = max(2, (max_bits + 2) // 2)
    bits = lambda mask: F.col("fp").bitwiseAND(F.col(mask))
    left = F.lit(max_bits) - F.bit_count(bits("mask").bitwiseXOR(F.col("value")))
    # pigeonhole: with left = q * segments + r, one of the first r + 1 segments
    # differs by q at most or one of the others by q - 1
    radius = F.floor(left / F.col("segments")) - (F.col("segment") > left % F.col("segments")).cast("int")
    masks, found, key = [0], [], ["mask", "value"]
    start = fps.select("fp", F.lit(0).cast("long").alias("mask"), F.lit(0).cast("long").alias("value"))
    asking = held = start
    while True:
        table = refined(held, masks, count).where("flip = 0").select(
            "fp", F.col("finer").alias("mask"), bits("finer").alias("value"))
        asked = refined(asking, masks, count).where(F.bit_count("flip") <= radius).select(
            # what was asked before stays asked: its flips are in the coarser value
            "fp", F.col("finer").alias("mask"),
            bits("finer").bitwiseXOR(F.col("flip")).bitwiseXOR(bits("mask")).bitwiseXOR(F.col("value")).alias("value"))
        if asking is not start:  # two segments may lead to one mask
            table, asked = table.distinct(), asked.distinct()
        often = scratch.written(table.groupBy(key).count().where(F.col("count") > BUCKET).select(key), "often")
        masks = [r.mask % (1 << BITS) for r in often.select("mask").distinct().collect()]  # at most a few hundred, by the bits
        if masks:
            asking = scratch.written(asked.join(often, key, "left_semi"), "asking")
            held = scratch.written(table.join(often, key, "left_semi").select("fp", "mask"), "held")
            table = table.join(often, key, "left_anti")
        fetched = asked.select(F.col("fp").alias("a"), *key).join(table.select(F.col("fp").alias("b"), *key), key)
        near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
        found.append(written(spark, fetched.where((F.col("a") > F.col("b")) & near).select("a", "b").distinct(), "links"))
        if not masks:
            scratch.drop()
            return reduce(DataFrame.union, found)


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a > b): root is the smallest
    node reachable.  Alternates large-star and small-star steps; each round
    is written to the shared folder, so lineage stays short, and the round
    before it is removed."""
    last = Scratch(spark)
    cur, state = last.written(edges, "edges"), None
    while True:
        both = cur.select(F.col("a").alias("u"), F.col("b").alias("v")).union(cur.select("b", "a"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        big = both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        floor = big.groupBy("a").agg(F.min("b").alias("m"))
        small = big.join(floor, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        this = Scratch(spark)
        cur = this.written(small.union(floor.select("a", F.col("m").alias("b"))).distinct(), "edges")
        now = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        last.drop()
        last = this
        if now == state:
            return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                cur.select("b", "b").distinct())
        state = now


def grouped(docs: DataFrame, size: int, max_bits: int, id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(id, fp) of every row of ``docs``, and (fp, component_id, root) of
    every fingerprint: the component's smallest id and smallest fingerprint."""
    spark = docs.sparkSession
    each = written(spark, fingerprints(docs, size, id, text), "fingerprints")
    fps = each.groupBy("fp").agg(F.min(id).alias("least_id"))
    edges = links(fps.select("fp"), max_bits)
    roots = written(spark, components(spark, edges), "roots")
    named = roots.join(fps, roots.node == fps.fp).groupBy("root").agg(F.min("least_id").alias("linked_id"))
    linked = roots.join(named, "root").select(F.col("node").alias("fp"), "linked_id", "root")
    # written, so that the last join shuffles both sides itself and a hot
    # fingerprint's rows can be split over tasks
    groups = written(spark, fps.join(linked, "fp", "left").select(
        "fp", F.coalesce("linked_id", "least_id").alias("component_id"), F.coalesce("root", "fp").alias("root")), "components")
    return each, groups


def near_duplicates(docs: DataFrame, size: int = 3, max_bits: int = 2, id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) for every row of ``docs``; the
    component is named by its smallest id."""
    each, groups = grouped(docs, size, max_bits, id, text)
    return each.join(groups, "fp").select(
        id, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, size: int = 3, max_bits: int = 2, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group: the one whose id names it, or,
    where no row of the group has an id, one with its smallest fingerprint
    (of its texts that of the smallest hash).  Rows that repeat both id and
    text count once."""
    spark = docs.sparkSession
    each, groups = grouped(docs, size, max_bits, id, text)
    found = written(spark, each.join(groups, "fp"), "groups")
    keepers = found.where(F.col("component_id") == F.col(id)).select(F.col(id).alias("_keep")).distinct()
    copies = W.partitionBy(id, F.xxhash64(text)).orderBy(id)
    # a shuffle join at every size: keepers grow with the documents
    kept = docs.join(keepers.hint("merge"), docs[id] == F.col("_keep"), "left_semi")
    kept = kept.withColumn("_copy", F.row_number().over(copies)).where("_copy = 1").drop("_copy")
    if found.where(F.col("component_id").isNull()).limit(1).count() == 0:
        return kept
    # a group of nameless rows holds its root: its rows of that fingerprint
    # are the same for every choice, and one of them is taken
    nameless = docs.where(F.col(id).isNull())
    own = fingerprints(nameless.select(F.struct(*nameless.columns).alias("_row"), F.col(text).alias("_text")), size, "_row", "_text")
    roots = groups.where(F.col("component_id").isNull() & (F.col("fp") == F.col("root"))).select("fp")
    # aggregated before the join, so a hot group is one row a task
    one = own.groupBy("fp").agg(F.min_by("_row", F.xxhash64(F.col("_row")[text])).alias("_row"))
    return kept.unionByName(one.join(roots.hint("merge"), "fp", "left_semi").select("_row.*"))
