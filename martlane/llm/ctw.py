"""Operator 7: language-model scores by context-tree weighting over bytes.

Each byte is eight binary decisions (the nodes of a 255-node tree), and each
decision has a context tree over the ``depth`` preceding bytes.  A node's
Krichevsky-Trofimov estimate and the product of its children are weighted
half and half, from the deepest contexts up; a byte's probability mixes the
estimates of all depths by the resulting weights.  Counts come from the
training rows, all of them; scores are the code length of the whole text and
its end under the fixed model.

How it is spread out: documents are dealt into buckets of about
``BUCKET_BYTES`` of text by a hash of id and text; rows that agree in both and
would fill a quarter of a bucket are one row with its number first, so no id
and no copies make a bucket large.  Long texts are worked on in blocks of
``PIECE_BYTES`` with their preceding bytes.  A bucket's task reduces it to
its distinct byte contexts and words with counts, which are summed over all
buckets, turned into the model by context, and joined back to the buckets
that use them; so no task holds more of the model than its own texts need.
Contexts are spread by their last two bytes, so deeper trees stay whole; the
two depths above have at most 257 contexts and go through the driver.

Defined results: null text is the empty text, which still codes its end;
repeated rows repeat their score; a null id is never held out; without
training rows the counts are zero and every bit costs one bit; an empty table
gives an empty one; only id and text of the rows are read, so other columns
clash with nothing.  Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlane.llm.base import crc_mod, texts_of, written

DEPTH = 4
BUCKET_BYTES = 24 << 20
PIECE_BYTES = 2 << 20
CONTEXTS_PER_PART = 200_000
GRAM, WORD, TEXT = 0, 1, 2
LOG_HALF = math.log(0.5)
SMALL = np.array([math.lgamma(n + 0.5) for n in range(64)])
SMALL_1 = np.array([math.lgamma(n + 1.0) for n in range(64)])


def log_gamma(n: np.ndarray, shift: float, small: np.ndarray) -> np.ndarray:
    """lgamma(n + shift) of whole n: a table, then Stirling's series."""
    x = np.maximum(n, 64) + shift
    long = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3)
    return np.where(n < 64, small[np.minimum(n, 63).astype(np.int64)], long)


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log probability of n0 zeros and n1 ones under the KT estimator."""
    return (log_gamma(n0, 0.5, SMALL) + log_gamma(n1, 0.5, SMALL) - 2 * SMALL[0] - log_gamma(n0 + n1, 1.0, SMALL_1))


class Level:
    """Nodes of one depth: key = context << 8 | node, sorted."""

    def __init__(self, key, n0, n1, below=None):
        self.key, self.n0, self.n1 = key, n0, n1
        own = LOG_HALF + log_kt(n0, n1)
        if below is None:
            self.weighted, self.stay = own - LOG_HALF, np.ones(len(key))
        else:
            self.weighted = np.logaddexp(own, LOG_HALF + below)
            self.stay = np.exp(own - self.weighted)
        self.one = (n1 + 0.5) / (n0 + n1 + 1)


def parents(level: Level, depth: int) -> tuple[Level, np.ndarray]:
    """The level above (contexts of ``depth`` bytes) and each node's place in it."""
    context = (level.key >> 8) & ((1 << 8 * depth) - 1)
    key, up = np.unique(context << 8 | (level.key & 255), return_inverse=True)
    total = [np.bincount(up, x, len(key)) for x in (level.n0, level.n1, level.weighted)]
    return Level(key, *total), up


def steps(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(8, n): node and bit of each of a byte's eight decisions."""
    byte = codes & 255
    j = np.arange(8)[:, None]
    return (1 << j) | (byte >> (8 - j)), (byte >> (7 - j)) & 1


def tree(codes: np.ndarray, counts: np.ndarray, depth: int, top: int) -> tuple[list[Level], list[np.ndarray], np.ndarray]:
    """Levels from ``depth`` up to ``top``, the place of each level's nodes in
    the next one, and the place of each (decision, code) in the first."""
    node, bit = steps(codes)
    key, at = np.unique((codes >> 8) << 8 | node, return_inverse=True)
    at = at.reshape(node.shape)
    n1 = np.bincount(at.ravel(), (counts * bit).ravel().astype(float), len(key))
    n = np.bincount(at.ravel(), np.broadcast_to(counts, node.shape).ravel().astype(float), len(key))
    levels, ups = [Level(key, n - n1, n1)], []
    for d in range(depth - 1, top - 1, -1):
        above, up = parents(levels[-1], d)
        levels.append(above)
        ups.append(up)
    return levels, ups, at


def descend(level: Level, sure: np.ndarray, mass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of a one decided so far and the mass left for below."""
    return sure + mass * level.stay * level.one, mass * (1 - level.stay)


def log_probabilities(codes, counts, depth, top, sure, mass) -> np.ndarray:
    """log10 probability of each code's byte; ``sure`` and ``mass`` (by
    context of the depth above ``top`` and node) come from the levels above."""
    levels, ups, at = tree(codes, counts, depth, top)
    above = (levels[-1].key >> 8 & ((1 << 8 * max(0, top - 1)) - 1)) << 8 | (levels[-1].key & 255)
    s, m = sure[above], mass[above]
    for level, up in zip(levels[:0:-1], ups[::-1]):
        s, m = (x[up] for x in descend(level, s, m))
    one = s + m * levels[0].one
    bit = steps(codes)[1]
    return np.log10(np.where(bit == 1, one[at], 1 - one[at])).sum(axis=0)


def grams(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes (byte, then preceding bytes from bit 8 up) of all texts, each
    with its end, and where each text's codes start."""
    pad = b"\0" * depth
    joined = np.frombuffer(pad + b"".join(t + b"\0" + pad for t in texts), np.uint8).astype(np.int64)
    size = np.array([len(t) + 1 for t in texts], np.int64)
    first = depth + np.cumsum(size + depth) - (size + depth)
    codes = joined[depth:].copy()
    for k in range(1, depth + 1):
        codes |= joined[depth - k:len(joined) - k] << 8 * k
    keep = np.ones(len(codes), bool)
    for k in range(depth):
        keep[first - depth + size + k] = False
    return codes[keep], np.cumsum(size) - size


def prepared(column: pa.Array) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass").lower() for t in texts_of(column)]


def pieces(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about PIECE_BYTES; a longer text by itself."""
    at = size = 0
    for i, t in enumerate(texts):
        if len(t) >= PIECE_BYTES:
            if at < i:
                yield at, i
            yield i, i + 1
            at, size = i + 1, 0
            continue
        size += len(t)
        if size >= PIECE_BYTES:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def blocks(texts: list[bytes], depth: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(range of texts, their codes, where each text's codes start); a long
    text comes in several blocks."""
    for a, b in pieces(texts):
        if b - a > 1 or len(texts[a]) <= PIECE_BYTES:
            yield a, b, *grams(texts[a:b], depth)
            continue
        for at in range(0, len(texts[a]), PIECE_BYTES):
            lead = min(at, depth)
            codes, start = grams([texts[a][at - lead:at + PIECE_BYTES]], depth)
            yield a, b, codes[lead:len(codes) - (at + PIECE_BYTES < len(texts[a]))], start


def words_of(text: bytes) -> Iterator[bytes] | list[bytes]:
    """Words of a text, one after the other where it is long."""
    return text.split() if len(text) < PIECE_BYTES else (m[0] for m in re.finditer(rb"[^\x20\x09-\x0D]+", text))


def word_key(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) - (1 << 63)


def bucket_keys(texts: list[bytes], learn: list[int], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kind, key, count over the training rows) of all that the texts need;
    ``learn`` tells how many training rows each text stands for."""
    gram_keys, gram_n = np.empty(0, np.int64), np.empty(0, np.int64)
    words: Counter = Counter()
    for value in sorted(set(learn), reverse=True):
        own = [t for t, x in zip(texts, learn) if x == value]
        for _, _, codes, _ in blocks(own, depth):
            key, n = np.unique(codes, return_counts=True)
            key, at = np.unique(np.concatenate([gram_keys, key]), return_inverse=True)
            gram_n = np.bincount(at, np.concatenate([gram_n, n * value]), len(key)).astype(np.int64)
            gram_keys = key
        for t in own:
            if value == 1:
                words.update(words_of(t))
            else:
                for w, n in Counter(words_of(t)).items():
                    words[w] += n * value
    kind = np.concatenate([np.full(len(gram_keys), GRAM), np.full(len(words), WORD), [TEXT]]).astype(np.int32)
    key = np.concatenate([gram_keys, np.array([word_key(w) for w in words], np.int64), [0]])
    n = np.concatenate([gram_n, np.fromiter(words.values(), np.int64, len(words)), [sum(learn)]])
    return kind, key.astype(np.int64), n.astype(np.int64)


def merged(rows: DataFrame) -> DataFrame:
    """``rows`` with a column ``copies``: one row for all that agree, where
    they would fill a quarter of a bucket, else each by itself."""
    alike = F.xxhash64("id", "text").alias("alike")
    size = F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 1)
    often = rows.groupBy(alike).agg(size.alias("size"), F.count(F.lit(1)).alias("n")).where(
        (F.col("n") > 1) & (F.col("size") >= BUCKET_BYTES // 4)).select("alike", F.lit(True).alias("often"))
    often = written(rows.sparkSession, often, "lm-copies")
    marked = rows.withColumn("alike", alike).join(often, "alike", "left")
    names = ["id", "text", "held"]
    alone = marked.where(F.col("often").isNull()).select(*names, F.lit(1).cast("long").alias("copies"))
    return alone.union(marked.where("often").groupBy(*names).agg(F.count(F.lit(1)).alias("copies")))


def scores(docs: DataFrame, held_out, depth: int = DEPTH, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    n_bytes, bits_per_byte) of every row.  ``held_out`` is a boolean column:
    rows that the model does not learn from.  base_score is that of a smoothed
    unigram model of words; score is the context-tree model's log10
    probability of the text."""
    if not 3 <= depth <= 6:
        raise ValueError("depth is 3 to 6 bytes")
    spark = docs.sparkSession
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, round(size / BUCKET_BYTES))
    rows = merged(rows).withColumn("bucket", F.pmod(F.xxhash64("id", "text"), F.lit(buckets)).cast("int"))

    def reduce(key: tuple, group: pa.Table) -> pa.Table:
        learn = [0 if h else n for h, n in zip(group["held"].to_pylist(), group["copies"].to_pylist())]
        kind, k, n = bucket_keys(prepared(group["text"]), learn, depth)
        return pa.table({"bucket": pa.array(np.full(len(k), key[0].as_py(), np.int32)), "kind": kind, "key": k, "n": n})

    keys = written(spark, rows.groupBy("bucket").applyInArrow(reduce, "bucket int, kind int, key long, n long"), "lm-keys")
    totals = written(spark, keys.groupBy("kind", "key").agg(F.sum("n").alias("n")), "lm-counts")
    facts = totals.where(F.col("kind") != GRAM).agg(
        F.sum("n").alias("tokens"), F.count(F.when(F.col("n") > 0, 1)).alias("distinct"),
        F.sum(F.when(F.col("kind") == TEXT, F.col("n"))).alias("texts")).first()
    tokens, distinct, texts = facts.tokens or 0, facts.distinct, facts.texts or 0

    table = totals.where(F.col("kind") == GRAM)
    parts = max(1, table.count() // CONTEXTS_PER_PART)
    table = table.select(F.pmod(F.xxhash64(F.shiftright("key", 8).bitwiseAND(0xFFFF)), F.lit(parts)).alias("part"), "key", "n")

    def tops(group: pa.Table) -> pa.Table:
        levels, _, _ = tree(group["key"].to_numpy(), group["n"].to_numpy(), depth, 2)
        last = levels[-1]
        return pa.table({"up": (last.key >> 8 & 255) << 8 | (last.key & 255), "n0": last.n0, "n1": last.n1, "below": last.weighted})

    above = table.groupBy("part").applyInArrow(tops, "up long, n0 double, n1 double, below double").groupBy("up").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("below").alias("below")).orderBy("up").toPandas()
    # at most 256 contexts of one byte x 255 nodes: a proven bound
    one = Level(above["up"].to_numpy(np.int64), *(above[c].to_numpy(float) for c in ("n0", "n1", "below")))
    none, up = parents(one, 0)
    sure, mass = (x[up] for x in descend(none, np.zeros(len(none.key)), np.ones(len(none.key))))
    sure, mass = descend(one, sure, mass)
    dense = np.zeros((2, 1 << 16))
    dense[:, one.key] = sure, mass

    def values(group: pa.Table) -> pa.Table:
        k = group["key"].to_numpy()
        return pa.table({"kind": np.full(len(k), GRAM, np.int32), "key": k,
                         "value": log_probabilities(k, group["n"].to_numpy(), depth, 2, *dense)})

    model = table.groupBy("part").applyInArrow(values, "kind int, key long, value double").union(
        totals.where(F.col("kind") == WORD).select("kind", "key", F.col("n").cast("double")))
    needed = keys.where(F.col("kind") != TEXT).select("bucket", "kind", "key").join(model, ["kind", "key"])
    scale = tokens + 0.1 * (distinct + 1)
    end = math.log10((texts + 0.1) / scale)

    def measure(group: pa.Table, look: pa.Table) -> pa.Table:
        kind, key, value = (look[c].to_numpy() for c in ("kind", "key", "value"))
        own = {k: np.argsort(key[kind == k]) for k in (GRAM, WORD)}
        (codes, logs), (hashes, counts) = ((key[kind == k][o], value[kind == k][o]) for k, o in own.items())
        del kind, key, value, own
        body = prepared(group["text"])
        words = set()
        for t in body:
            words.update(words_of(t))
        words = list(words)
        c = counts[np.searchsorted(hashes, np.array([word_key(w) for w in words], np.int64))] if words else np.empty(0)
        log_of = dict(zip(words, np.log10((c + 0.1) / scale).tolist()))
        new = {words[i] for i in np.flatnonzero(c == 0).tolist()}
        del words, c, hashes, counts
        base, known, n, score = [], [], [], np.zeros(len(body))
        for a, b, grams_of, start in blocks(body, depth):
            score[a:b] += np.add.reduceat(logs[np.searchsorted(codes, grams_of)], start)
        for t in body:
            own = Counter(words_of(t))
            base.append(math.fsum(log_of[w] * c for w, c in own.items()) + end)
            n.append(own.total() + 1)
            known.append(own.total() - sum(c for w, c in own.items() if w in new) + (texts > 0))
        size = np.array([len(t) for t in body], np.int64)
        return pa.table({
            "id": group["id"], "held_out": group["held"], "n_tokens": pa.array(n, pa.int64()),
            "n_known": pa.array(known, pa.int64()), "train_tokens": np.full(len(n), tokens, np.int64),
            "base_score": pa.array(base, pa.float64()), "score": score, "n_bytes": size,
            "bits_per_byte": -score * math.log2(10) / (size + 1), "copies": group["copies"]})

    kind = docs.schema[id].dataType.simpleString()
    result = rows.groupBy("bucket").cogroup(needed.groupBy("bucket")).applyInArrow(
        measure, f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
        "score double, n_bytes long, bits_per_byte double, copies long")
    every = F.explode(F.sequence(F.lit(1).cast("long"), "copies"))
    return result.select("*", every.alias("copy")).drop("copies", "copy").withColumnRenamed("id", id)
