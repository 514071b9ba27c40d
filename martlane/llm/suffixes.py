"""Operator 12: suffix-array dedup by hash-compared suffix sorting.

Removes every byte covered by a string of ``length`` bytes (a window) that
also starts earlier: in a document of smaller id, or before in the same one.

Sorting all suffixes of a corpus would shuffle it many times over, so windows
meet by content.  The window's anchor is its ``GRAM``-byte gram of least hash;
a run of windows with one anchor makes a segment.  Prefix polynomial hashes
(modulo 2^64, a random value for each byte) give any string's hash at once.

1. Tasks hash their documents in blocks.  Copies of a segment inside a block
   are found there and their bytes compared; the first of each goes on with
   two hashes, of the gram (key) and of the whole segment.
2. Segments meet by key.  Those equal to an earlier one are repeated runs.
   Where first ones of different segments share a key, single windows may
   still be equal: these fetch their bytes from the documents.
3. A task takes whole keys, lays the bytes of their segments side by side and
   sorts two suffixes of each by mergesort: from the anchor forwards and
   backwards.  Suffixes are compared by a binary search over prefix hashes
   for their common extension and by the byte after it, and extensions of
   neighbours are verified byte by byte; should one differ, the block is
   sorted by its bytes instead.  Windows at one distance from their anchors
   are equal where both extensions reach far enough.
4. A key with more than ``HOT`` different segments is not sorted: its windows
   are hashed (two hashes) and the least place of each found by aggregation.

Defined results: a null text is empty.  A null id comes before all others.
Rows that agree in id and text are one document, all cut alike; rows that
agree in id only are different documents in the order of their text's hash.
Texts under ``length`` bytes stay whole; long texts are hashed in overlapping
blocks.  Of equal strings the first place stays.  Ids are integers.  Result
columns replace input columns of the same name; other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlane.llm.base import Scratch, appended, chunks, unused, without, written

LENGTH, GRAM = 100, 32
BLOCK_BYTES = 2 << 20
#: Different segments of one key up to which their suffixes are sorted.
HOT = 2048
#: Segments that a task sorts at a time (whole keys).
SORT_ROWS = 16_384
NO_ID = -(1 << 63)


KEPT: dict[int, tuple] = {}  # by seed, the longest so far


def powers(seed: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Value of each byte, ``n`` powers or more of an odd base, and of its inverse."""
    if seed not in KEPT or len(KEPT[seed][1]) < n:
        rng = np.random.default_rng(seed)
        values = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = int(rng.integers(0, 1 << 62)) * 2 + 1
        size = max(1 << 16, n + n // 8)
        out = [np.full(size, b, np.uint64) for b in (base, pow(base, -1, 1 << 64))]
        for p in out:
            p[0] = 1
            np.multiply.accumulate(p, out=p)
        KEPT[seed] = values, *out
    return KEPT[seed]


class Prefixes:
    """Prefix polynomial hashes of ``data``: the hash of any substring."""

    def __init__(self, data: np.ndarray, seed: int = 1) -> None:
        values, power, self.inverse = powers(seed, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * power[:len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return (self.sums[start + size] - self.sums[start]) * self.inverse[start]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (their low bits are weak)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# -- segments of a block ----------------------------------------------------
def segments(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Of the texts that lie side by side in ``data`` up to ``ends``: (anchor,
    first window, last window) of each segment, and the prefix hashes."""
    prefix = Prefixes(data)
    grams = len(data) - GRAM + 1
    if grams <= 0 or len(data) < length:
        none = np.zeros(0, np.int64)
        return none, none, none, prefix
    at = np.arange(grams)
    # the upper 40 bits of the hash, then the place: least hash, leftmost
    low = (mixed(prefix.of(at, GRAM)) & ~np.uint64((1 << 24) - 1)) | at.astype(np.uint64)
    span, size = length - GRAM + 1, 1
    while 2 * size <= span:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    low = np.minimum(low[:len(data) - length + 1], low[span - size:])
    anchor = (low & np.uint64((1 << 24) - 1)).astype(np.int64)
    text = np.searchsorted(ends, np.arange(len(anchor)), side="right")
    inside = np.arange(len(anchor)) + length <= ends[text]
    # a window over a text's end is no window; of the others, runs of one anchor
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new & inside)
    stop = np.flatnonzero(np.append(new[1:], True) | ~np.append(inside[1:], False))
    last = stop[np.searchsorted(stop, first)]
    return anchor[first], first, last, prefix


def equal_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the strings of ``size`` at ``a`` and at ``b`` are equal."""
    out = np.ones(len(a), bool)
    for r in range(0, len(a), 1 << 15):  # bounded memory
        own = slice(r, r + (1 << 15))
        for k in range(0, int(size[own].max(initial=0)), 16):
            steps = np.clip(np.arange(k, k + 16)[None, :], 0, np.maximum(size[own, None] - 1, 0))
            same = data[np.minimum(a[own, None] + steps, len(data) - 1)] == data[np.minimum(b[own, None] + steps, len(data) - 1)]
            out[own] &= (same | (size[own, None] <= k)).all(axis=1)
    return out


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges of each document, sorted, those that touch as one."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    far = end + doc * (1 << 40)
    reach = np.maximum.accumulate(far) if len(far) else far
    new = np.ones(len(doc), bool)
    new[1:] = start[1:] + doc[1:] * (1 << 40) > reach[:-1]
    at = np.flatnonzero(new)
    return doc[at], start[at], np.maximum.reduceat(end, at) if len(at) else end


def block_rows(texts: list[tuple[int, int, int, bytes]], length: int) -> dict[str, np.ndarray]:
    """Rows of a block of (id, body, offset, bytes): repeated ranges (from at,
    after bytes; before is -1) and first segments (key, whole, at, before,
    after)."""
    texts = sorted(texts, key=lambda t: t[:3])
    data = np.frombuffer(b"".join(t[3] for t in texts), np.uint8)
    ends = np.cumsum([len(t[3]) for t in texts])
    anchor, first, last, prefix = segments(data, ends, length)
    key, size = mixed(prefix.of(anchor, GRAM)), last - first + length
    # the shape of a segment belongs to its hash
    whole = mixed(Prefixes(data, 2).of(first, size) ^ ((anchor - first) * 256 + (last - first)).astype(np.uint64))
    text = np.searchsorted(ends, first, side="right")
    zero = np.concatenate([[0], ends])[text]
    offset = np.array([t[2] for t in texts], np.int64)[text]
    _, head, group = np.unique(whole, return_index=True, return_inverse=True)
    head = head[group]  # the earliest of the same hash, as texts are sorted
    copy = head != np.arange(len(whole))
    same = np.flatnonzero(copy)
    copy[same] = (key[same] == key[head[same]]) & (size[same] == size[head[same]])
    same = np.flatnonzero(copy)
    copy[same] = equal_bytes(data, first[same], first[head[same]], size[same])
    doc, start, end = merged(text[copy], (first - zero + offset)[copy], (first - zero + offset + size)[copy])
    go = ~copy
    rows = {
        "id": np.concatenate([np.array([t[0] for t in texts], np.int64)[d] for d in (doc, text[go])]),
        "body": np.concatenate([np.array([t[1] for t in texts], np.int64)[d] for d in (doc, text[go])]),
        "key": np.concatenate([mixed(np.arange(1, len(doc) + 1).astype(np.uint64)).view(np.int64), key[go].view(np.int64)]),
        "whole": np.concatenate([np.zeros(len(doc), np.int64), whole[go].view(np.int64)]),
        "at": np.concatenate([start, (anchor - zero + offset)[go]]),
        "before": np.concatenate([np.full(len(doc), -1), (anchor - first)[go]]),
        "after": np.concatenate([end - start, (last - anchor)[go]]),
    }
    return rows


PLACE = ("id", "body", "at")
ROWS = "id long, body long, key long, whole long, at long, before int, after int"


def numbered(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, body, text): place of the documents in order; null is the least."""
    return docs.select(F.coalesce(F.col(id).cast("long"), F.lit(NO_ID)).alias("id"),
                       F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("body"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def pieces(id: int, body: int, text: bytes, length: int, block: int) -> Iterator[tuple[int, int, int, bytes]]:
    """Blocks of a text, each with all windows that start in it."""
    for at in range(0, max(1, len(text) - length + 1), block):
        yield id, body, at, text[at:at + block + length - 1]


def all_segments(docs: DataFrame, length: int, id: str, text: str) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[tuple, tuple] = {}
        size = 0

        def work() -> Iterator[pa.RecordBatch]:
            rows = block_rows(list(waiting.values()), length)
            for at in range(0, len(rows["id"]), 1 << 16):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[f.name][at:at + (1 << 16)], f.type) for f in schema], schema=schema)

        for b in chunks(batches, 64):
            for i, body, t in zip(*(b.column(k).to_pylist() for k in range(3))):
                for p in pieces(i, body, t.encode(), length, BLOCK_BYTES):
                    if len(p[3]) < length or p[:3] in waiting:
                        continue
                    waiting[p[:3]] = p
                    size += len(p[3])
                    if size >= BLOCK_BYTES:
                        yield from work()
                        waiting.clear()
                        size = 0
        if waiting:
            yield from work()

    schema = pa.schema([(n, pa.int32() if k == "int" else pa.int64()) for n, k in (x.split() for x in ROWS.split(", "))])
    return numbered(docs, id, text).mapInArrow(run, ROWS)


# -- suffixes of the segments of a key --------------------------------------
class Suffixes:
    """Suffixes at ``start`` with ``size`` bytes, compared by prefix hashes."""

    def __init__(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        self.data, self.start, self.size = data, start, size
        self.prefix = Prefixes(data)

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common extension, by binary search."""
        a, b = self.start[i], self.start[j]
        low, high = np.zeros(len(a), np.int64), np.minimum(self.size[i], self.size[j])
        for _ in range(int(high.max(initial=0)).bit_length()):
            mid = (low + high + 1) >> 1
            same = self.prefix.of(a, mid) == self.prefix.of(b, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether suffix ``i`` is less than ``j``; a prefix is less."""
        n = self.common(i, j)
        over = n >= np.minimum(self.size[i], self.size[j])
        pick = lambda k: self.data[np.where(over, 0, self.start[k] + n)]
        return np.where(over, self.size[i] < self.size[j], pick(i) < pick(j))

    def sort(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order of the suffixes inside each group (groups lie side by side),
        and the common extension with the one before, -1 at a group's first."""
        n = len(group)
        head = np.ones(n, bool)
        head[1:] = group[1:] != group[:-1]
        first = np.flatnonzero(head)[np.cumsum(head) - 1]
        count = np.bincount(np.cumsum(head) - 1, minlength=1)[np.cumsum(head) - 1]
        order, run = np.arange(n), 1
        while run < int(count.max(initial=0)):
            here = np.flatnonzero(count > run)
            place = here - first[here]
            mine, other = place // run, (place // run) ^ 1
            low = np.minimum(other * run, count[here])
            floor, high = low.copy(), np.minimum(low + run, count[here])
            right = (mine & 1).astype(bool)
            for _ in range(run.bit_length()):
                open_ = low < high
                mid = (low + high) >> 1
                probe = order[first[here] + np.minimum(mid, count[here] - 1)]
                own = order[here]
                # from the right run: those not above it come first (stable)
                less = np.where(right, ~self.before(own, probe), self.before(probe, own)) & open_
                low = np.where(less, mid + 1, low)
                high = np.where(open_ & ~less, mid, high)
            to = first[here] + (mine & ~1) * run + place % run + (low - floor)
            out = order.copy()
            out[to] = order[here]
            order, run = out, run * 2
        common = np.full(n, -1, np.int64)
        inner = np.flatnonzero(~head)
        common[inner] = self.common(order[inner - 1], order[inner])
        if not self.verified(order, common, inner):
            return self.by_bytes(group, head)
        return order, common

    def verified(self, order: np.ndarray, common: np.ndarray, at: np.ndarray) -> bool:
        """Compare the bytes that the hashes call equal, and the next ones."""
        a, b = order[at - 1], order[at]
        if not equal_bytes(self.data, self.start[a], self.start[b], common[at]).all():
            return False
        more = common[at] < np.minimum(self.size[a], self.size[b])
        a, b, n = a[more], b[more], common[at][more]
        return bool((self.data[self.start[a] + n] < self.data[self.start[b] + n]).all())

    def by_bytes(self, group: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = [self.data[s:s + k].tobytes() for s, k in zip(self.start.tolist(), self.size.tolist())]
        order = np.array(sorted(range(len(own)), key=lambda i: (group[i], own[i])), np.int64)
        common = np.full(len(own), -1, np.int64)
        for k in np.flatnonzero(~head).tolist():
            x, y = own[order[k - 1]], own[order[k]]
            common[k] = next((m for m, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        return order, common


def repeated_windows(group: np.ndarray, data: bytes, ends: np.ndarray, before: np.ndarray, after: np.ndarray,
                     place: np.ndarray, length: int) -> np.ndarray:
    """For each segment (grouped by key, in order of place inside) and each
    distance of a window's start to its anchor, from 0 on: whether an equal
    window of that key starts at an earlier place.  ``before`` and ``after``:
    windows before and after the anchor; a segment's bytes begin at its first
    window; ``place`` numbers equal places alike."""
    data = np.frombuffer(data, np.uint8)
    begin = np.concatenate([[0], ends[:-1]])
    anchor = begin + before
    forward = Suffixes(data, anchor, ends - anchor)
    backward = Suffixes(data[::-1], len(data) - anchor, before)
    n, most = len(group), length - GRAM + 1
    out = np.zeros((n, most), bool)
    (f_order, f_common), (b_order, b_common) = forward.sort(group), backward.sort(group)
    for d in range(most):
        live = np.flatnonzero((before >= d) & (-after <= d))
        if len(live) < 2:
            continue
        f_class, b_class = np.empty(n, np.int64), np.empty(n, np.int64)
        f_class[f_order] = np.cumsum(f_common < length - d)
        b_class[b_order] = np.cumsum(b_common < d)
        both = f_class[live] * (n + 1) + b_class[live]
        _, head, of = np.unique(both, return_index=True, return_inverse=True)
        out[live, d] = place[live[head]][of] != place[live]
    return out


def sorted_runs(rows: DataFrame, length: int) -> DataFrame:
    """(id, body, at, upto): ranges of repeated windows of the segments in
    ``rows`` (key, id, body, at, before, after, bytes)."""
    schema = pa.schema([("id", pa.int64()), ("body", pa.int64()), ("at", pa.int64()), ("upto", pa.int64())])

    def work(t: pa.Table) -> pa.RecordBatch:
        key, id, body, at, before, after = (t[c].to_numpy().astype(np.int64) for c in ("key", *PLACE, "before", "after"))
        new = np.ones(len(key), bool)
        for c in (key, id, body, at):
            new[1:] &= c[1:] == c[:-1]
        new[1:] = ~new[1:]
        parts = t["bytes"].to_pylist()
        found = repeated_windows(key, b"".join(parts), np.cumsum([len(p) for p in parts]), before, after, np.cumsum(new), length)
        # runs of distances: a window at distance d starts at the anchor - d
        wide = np.zeros((len(key), found.shape[1] + 2), np.int8)
        wide[:, 1:-1] = found
        step = np.diff(wide, axis=1)
        row, least = np.nonzero(step == 1)
        _, over = np.nonzero(step == -1)
        cols = (id[row], body[row], at[row] - (over - 1), at[row] - least + length)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], schema=schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) < SORT_ROWS:
                continue
            t = pa.Table.from_batches(held)
            keys = t["key"].to_numpy()
            whole = int(np.searchsorted(keys, keys[-1]))  # rows of keys that are complete
            if whole:
                yield work(t.slice(0, whole))
            held = t.slice(whole).combine_chunks().to_batches()
        if held:
            yield work(pa.Table.from_batches(held))

    dealt = rows.repartition("key").sortWithinPartitions("key", *PLACE)
    return dealt.mapInArrow(run, "id long, body long, at long, upto long")


# -- the whole --------------------------------------------------------------
def near_bytes(docs: DataFrame, wanted: DataFrame, length: int, id: str, text: str) -> DataFrame:
    """The bytes of the segments ``wanted``, or the hashes of their windows
    where the key is hot (n above ``HOT``)."""
    of = wanted.groupBy("id", "body").agg(F.collect_set(F.struct("key", "at", "before", "after", "n")).alias("own"))
    joined = numbered(docs, id, text).join(of.hint("merge"), ["id", "body"])
    schema = pa.schema([("id", pa.int64()), ("body", pa.int64()), ("key", pa.int64()), ("whole", pa.int64()),
                        ("at", pa.int64()), ("before", pa.int32()), ("after", pa.int32()), ("bytes", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for b in chunks(batches, 64):
            for i, body, t, own in zip(*(b.column(c).to_pylist() for c in ("id", "body", "text", "own"))):
                if (i, body) == last:  # repeated rows lie side by side after the join
                    continue
                last, raw = (i, body), t.encode()
                cold = [s for s in own if s["n"] <= HOT]
                hot = [s for s in own if s["n"] > HOT]
                starts = np.concatenate([np.arange(s["at"] - s["before"], s["at"] + s["after"] + 1) for s in hot]) if hot else np.zeros(0, np.int64)
                hashes = [np.zeros(0, np.int64)] * 2
                if hot:
                    low = int(starts.min())
                    near = np.frombuffer(raw[low:int(starts.max()) + length], np.uint8)
                    hashes = [mixed(Prefixes(near, s).of(starts - low, length)).view(np.int64) for s in (1, 2)]
                n, m = len(cold), len(starts)
                column = lambda name: np.array([s[name] for s in cold], np.int64)
                zeros = np.zeros(m, np.int64)
                both = {"id": np.full(n + m, i), "body": np.full(n + m, body), "key": np.concatenate([column("key"), hashes[0]]),
                        "whole": np.concatenate([np.zeros(n, np.int64), hashes[1]]), "at": np.concatenate([column("at"), starts]),
                        "before": np.concatenate([column("before"), zeros]), "after": np.concatenate([column("after"), zeros])}
                told = [raw[s["at"] - s["before"]:s["at"] + s["after"] + length] for s in cold] + [None] * m
                yield pa.RecordBatch.from_arrays([*(pa.array(v, schema.field(k).type) for k, v in both.items()),
                                                  pa.array(told, pa.binary())], schema=schema)

    return joined.mapInArrow(run, "id long, body long, key long, whole long, at long, before int, after int, bytes binary")


def repeated_ranges(docs: DataFrame, scratch: Scratch, length: int = LENGTH, id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(id, body, at, upto): byte ranges covered by repeated windows."""
    rows = all_segments(docs, length, id, text).repartition("key")
    # ranges found in a block go through under any key; of the others, each
    # key's segments in order of hash and place
    first = F.first(F.struct(*PLACE)).over(Window.partitionBy("key", "whole").orderBy(*PLACE))
    rows = rows.withColumn("copy", F.when(F.col("before") >= 0, F.struct(*PLACE) != first))
    rows = rows.withColumn("n", F.count(F.when(~F.col("copy"), True)).over(Window.partitionBy("key")))
    rows = scratch.written(rows.where("copy IS NULL OR copy OR n > 1").drop("whole"), "suffix-segments")
    direct = rows.where("copy IS NULL").select("id", "body", "at", (F.col("at") + F.col("after")).alias("upto"))
    copies = rows.where("copy").select("id", "body", (F.col("at") - F.col("before")).alias("at"),
                                       (F.col("at") + F.col("after") + length).alias("upto"))
    near = scratch.written(near_bytes(docs, rows.where("NOT copy AND n > 1"), length, id, text), "suffix-bytes")
    cold = sorted_runs(near.where("bytes IS NOT NULL").drop("whole"), length)
    hot = near.where("bytes IS NULL").select("key", "whole", *PLACE)
    least = hot.groupBy("key", "whole").agg(F.min(F.struct(*PLACE)).alias("least"), F.max(F.struct(*PLACE)).alias("most"))
    hot = hot.join(least.where("least != most").hint("merge"), ["key", "whole"]).where(F.struct(*PLACE) != F.col("least"))
    hot = hot.select("id", "body", "at", (F.col("at") + length).alias("upto"))
    return direct.unionByName(copies).unionByName(cold).unionByName(hot)


FIELDS = {f.name: f for f in (
    T.StructField("n_bytes", T.LongType(), False), T.StructField("n_removed", T.LongType(), False),
    T.StructField("n_spans", T.LongType(), False), T.StructField("removed", T.StringType(), False),
    T.StructField("kept", T.BinaryType(), False), T.StructField("kept_sha256", T.StringType(), False))}


def dedup_bytes(docs: DataFrame, length: int = LENGTH, id: str = "doc_id", text: str = "text",
                outputs: Sequence[str] = ("n_bytes", "n_removed", "n_spans", "removed", "kept")) -> DataFrame:
    """``docs`` with the columns ``outputs``: n_bytes, n_removed, n_spans,
    removed (start:end of each removed run, in bytes), kept (the remaining
    bytes) and kept_sha256."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    of, body, own_ranges = (unused(docs, n) for n in ("_id", "_body", "_ranges"))
    ranges = repeated_ranges(docs, scratch, length, id, text).groupBy(F.col("id").alias(of), F.col("body").alias(body)).agg(
        F.collect_list(F.struct("at", "upto")).alias(own_ranges))
    ranges = written(spark, ranges, "suffix-ranges")
    scratch.drop()
    place = [F.coalesce(docs[id].cast("long"), F.lit(NO_ID)) == F.col(of),
             F.xxhash64(F.coalesce(docs[text], F.lit(""))) == F.col(body)]
    # a shuffle join at every size: the ranges grow with the texts
    joined = docs.join(ranges.hint("merge"), place[0] & place[1], "left").drop(of, body)
    schema = appended(docs.schema, [FIELDS[o] for o in outputs])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, 64):
            found: dict[str, list] = {f: [] for f in FIELDS}
            for t, own in zip(b.column(text).to_pylist(), b.column(own_ranges).to_pylist()):
                raw, spans = (t or "").encode(), []
                if own:
                    zero = np.zeros(len(own), np.int64)
                    _, start, end = merged(zero, *(np.array([x[c] for x in own], np.int64) for c in ("at", "upto")))
                    spans = list(zip(start.tolist(), end.tolist()))
                at, left = 0, []
                for s, e in spans:
                    left.append(raw[at:s])
                    at = e
                rest = b"".join([*left, raw[at:]])
                for f, value in zip(FIELDS, (len(raw), len(raw) - len(rest), len(spans), ",".join(f"{s}:{e}" for s, e in spans),
                                             rest, hashlib.sha256(rest).hexdigest())):
                    found[f].append(value)
            arrays, names = without(b, [own_ranges, *outputs])
            kinds = {"removed": pa.string(), "kept": pa.binary(), "kept_sha256": pa.string()}
            yield pa.RecordBatch.from_arrays(
                [*arrays, *(pa.array(found[o], kinds.get(o, pa.int64())) for o in outputs)], names=[*names, *outputs])

    return joined.mapInArrow(run, schema)
