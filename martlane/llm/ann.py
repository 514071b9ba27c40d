"""Operator 10: approximate nearest neighbours with hash-prefix forests.

Equal vectors are merged first (a hot vector is one row with its smallest
ids).  The distinct vectors are dealt into shards of about ``SHARD_ROWS``;
each shard holds a forest: per tree, the rows sorted by a long string of hash
bits (signs of random projections against the shard's medians).  A query
descends in every tree to the rows that share its longest prefix and then
ascends in all trees at once, a bit at a time, until the ranges together hold
``gather`` times the shard's rows; their union is ranked by exact distance.
Queries meet shards in blocks, and the shards' best are merged.

Defined results: rows whose vector is null, zero, or holds a null or
non-finite component take no part, as query or candidate; vectors of one
length are a table of their own, as others are at no distance; a repeated row counts once; ties go to the smaller id; a
query's own row is never its neighbour; with fewer candidates all are
returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martlane.llm.base import written

TREES = 24
BITS = 32
SHARD_ROWS = 8192
QUERY_ROWS = 2048
GATHER = 1.5
SEED = 10


def usable(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """(id, v): distinct rows that take part, as doubles."""
    v = F.col("v")
    rows = vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(
        F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0))
    finite = F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return rows.where(finite & F.exists(v, lambda x: x != 0)).distinct()


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    if not len(column):
        return np.empty((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class Forest:
    """Sorted hash strings of one shard."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = SEED):
        self.vectors, self.trees, self.bits = vectors, trees, bits
        rng = np.random.default_rng(seed)
        self.planes = rng.standard_normal((vectors.shape[1], trees * bits))
        projected = vectors @ self.planes
        self.middle = np.median(projected, axis=0)
        labels = self.strings(projected)
        self.order = np.argsort(labels, axis=0, kind="stable")
        self.sorted = np.take_along_axis(labels, self.order, axis=0)

    def strings(self, projected: np.ndarray) -> np.ndarray:
        signs = (projected > self.middle).reshape(-1, self.trees, self.bits).astype(np.int64)
        return signs @ (1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64))

    def search(self, queries: np.ndarray, enough: float):
        """For each query the rows of the deepest prefix level whose ranges,
        over all trees, hold ``enough`` rows."""
        labels = self.strings(queries @ self.planes)
        total = len(self.vectors) * self.trees
        low = np.zeros((len(queries), self.trees), np.int64)
        high = np.full((len(queries), self.trees), len(self.vectors), np.int64)
        climbing = np.ones(len(queries), bool)
        for level in range(self.bits, 0, -1):
            free = self.bits - level
            start = labels >> free << free
            lo, hi = np.empty_like(low), np.empty_like(high)
            for t in range(self.trees):
                lo[:, t] = np.searchsorted(self.sorted[:, t], start[:, t])
                hi[:, t] = np.searchsorted(self.sorted[:, t], start[:, t] + (1 << free))
            stop = climbing & ((hi - lo).sum(axis=1) >= min(enough, total))
            low[stop], high[stop] = lo[stop], hi[stop]
            climbing &= ~stop
            if not climbing.any():
                break
        for q in range(len(queries)):
            found = np.zeros(len(self.vectors), bool)
            for t in range(self.trees):
                found[self.order[low[q, t]:high[q, t], t]] = True
            yield np.flatnonzero(found)


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, gather: float = GATHER, id: str = "vec_id",
            vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``is_query`` (a
    condition on the id column) holds, its ``k`` nearest found rows by
    Euclidean distance."""
    spark = vectors.sparkSession
    rows = written(spark, usable(vectors, id, vector), "vectors")
    # each distinct vector with its k + 1 smallest ids: limited before the
    # shuffle, so a hot vector sends a few rows a task
    first = rows.withColumn("n", F.row_number().over(W.partitionBy("v").orderBy("id"))).where(F.col("n") <= k + 1)
    distinct = written(spark, first.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn(
        "least", F.col("ids")[0]), "distinct-vectors")
    asked = rows.withColumnRenamed("id", id).where(is_query).withColumnRenamed(id, "query_id")
    asked = written(spark, asked.join(distinct.select("v", "least"), "v").select("query_id", F.col("least").alias("q")), "queries")
    queries = distinct.join(asked.select("q").distinct(), F.col("least") == F.col("q"), "left_semi").select(
        F.col("least").alias("q"), F.col("v").alias("qv"))
    queries = written(spark, queries, "query-vectors")
    # shards and blocks of each length; a row for each, no more than the longest vector has components
    shards = distinct.groupBy(F.size("v").alias("dim")).agg(F.ceil(F.count(F.lit(1)) / SHARD_ROWS).cast("int").alias("shards"))
    blocks = queries.groupBy(F.size("qv").alias("dim")).agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("blocks"))
    dims = F.broadcast(shards.join(blocks, "dim"))
    held = distinct.withColumn("dim", F.size("v")).join(dims, "dim").select(
        "dim", F.pmod(F.xxhash64("least"), F.col("shards")).cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "least", "v")
    sent = queries.withColumn("dim", F.size("qv")).join(dims, "dim").select(
        "dim", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"),
        F.pmod(F.xxhash64("q", F.lit(1)), F.col("blocks")).cast("int").alias("block"), "q", "qv")

    def meet(shard: pa.Table, block: pa.Table) -> pa.Table:
        out = {"q": [], "least": [], "score": []}
        if len(shard) and len(block):
            shard = shard.sort_by("least")
            ids, asks = shard["least"].to_numpy(), block["q"].to_numpy()
            forest, qv = Forest(matrix(shard["v"])), matrix(block["qv"])
            # k + 1 rows a tree: one range at least then holds so many rows
            enough = max(gather * len(ids), forest.trees * (k + 1))
            for i, found in enumerate(forest.search(qv, enough)):
                score = np.sqrt(((forest.vectors[found] - qv[i]) ** 2).sum(axis=1))
                best = np.argsort(score, kind="stable")[:k + 1]
                out["q"].append(np.full(len(best), asks[i]))
                out["least"].append(ids[found[best]])
                out["score"].append(score[best])
        return pa.table({c: np.concatenate(x) if x else np.empty(0, float if c == "score" else np.int64)
                         for c, x in out.items()})

    met = held.groupBy("dim", "shard", "block").cogroup(sent.groupBy("dim", "shard", "block")).applyInArrow(
        meet, "q long, least long, score double")
    by_q = W.partitionBy("q")
    best = met.withColumn("n", F.row_number().over(by_q.orderBy("score", "least"))).where(F.col("n") <= k + 1)
    ids = best.join(distinct.select("least", "ids"), "least").select("q", "score", F.explode("ids").alias("vec_id"))
    ids = ids.withColumn("n", F.row_number().over(by_q.orderBy("score", "vec_id"))).where(F.col("n") <= k + 1)
    pairs = asked.join(ids.drop("n"), "q").where(F.col("query_id") != F.col("vec_id"))
    ranked = pairs.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
