"""Operator 5: mixing sources to target weights by temperature.

A source's weight is its token share to the power of ``alpha``, normalised.
Alpha is found by repeated section of [0, 1]: the flattest mix in which no
source repeats more than ``max_repeats`` times and, if one is given, whose
entropy does not exceed ``entropy`` (alpha 1 keeps the shares as they are).
The token budget is the least that uses every document once, so mixing only
repeats, unless ``budget`` names another.  Weights are realised as block
permutations: a source's stream is one whole permutation of its documents
after another, each shuffled by its own hash, and the budget ends inside the
last block.

A document's place in a block needs the tokens before it.  Blocks are cut
into ranges of the permutation hash with some thousands of rows whatever
their source; sums of ranges are added up first, then the rows of a range.
So a source with a third of all rows is spread like the others.

Defined results: a null source is a source of its own; null and empty texts
have no tokens and ride along in every block; repeated rows (same id, source
and text) go together; an empty table gives an empty mix; if no document has
a token, every document is used once.  Other columns pass through ``mix``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martlane.llm.base import SPACE_CLASS, written

MAX_REPEATS = 2.0
SECTIONS = 16
ROUNDS = 5
RANGE_ROWS = 4096
SEED = 5


def measured(docs: DataFrame, id: str, source: str, text: str) -> DataFrame:
    """(id, source, body, copies, tokens): one row per document."""
    words = F.size(F.expr(f"array_remove(split(coalesce(`{text}`, ''), r'[{SPACE_CLASS}]+'), '')"))
    rows = docs.select(F.col(id).alias("id"), F.col(source).alias("source"), F.xxhash64(text).alias("body"),
                       words.cast("long").alias("tokens"))
    return rows.groupBy("id", "source", "body").agg(
        F.count(F.lit(1)).alias("copies"), F.sum("tokens").alias("tokens"))


def solve(sources: DataFrame, max_repeats: float, entropy: float | None, budget: float | None) -> tuple[float, float, float]:
    """(alpha, log of the weights' norm, budget) for ``sources`` (tokens,
    share).  Each round is one aggregate that tries all sections at once."""
    low, high = 0.0, 1.0
    share, p = F.col("share"), F.log("share")
    for _ in range(ROUNDS):
        tries = [low + (high - low) * k / SECTIONS for k in range(SECTIONS + 1)]
        sums = []
        for k, a in enumerate(tries):
            # repeats = weight * budget / tokens; without a budget the least
            # repeated source has exactly one
            sums += [F.sum(F.pow(share, F.lit(a))).alias(f"z{k}"), F.sum(F.pow(share, F.lit(a)) * p * a).alias(f"s{k}"),
                     F.max(F.lit(a - 1) * p).alias(f"most{k}"), F.min(F.lit(a - 1) * p).alias(f"least{k}")]
        r = sources.agg(F.sum("tokens").alias("all"), *sums).first()

        def fits(k: int) -> bool:
            z = r[f"z{k}"]
            if entropy is not None and math.log(z) - r[f"s{k}"] / z > entropy + 1e-12:
                return False
            least = r[f"least{k}"] if budget is None else math.log(z) + math.log(r["all"] / budget)
            return r[f"most{k}"] - least <= math.log(max_repeats) + 1e-12

        best = next((k for k in range(SECTIONS + 1) if fits(k)), SECTIONS)
        alpha, norm = tries[best], math.log(r[f"z{best}"])
        total = math.exp(math.log(r["all"]) + norm - r[f"least{best}"]) if budget is None else budget
        if best == 0:
            break
        low, high = tries[best - 1], tries[best]
    return alpha, norm, total


def plan(docs: DataFrame, max_repeats: float = MAX_REPEATS, entropy: float | None = None, budget: float | None = None,
         id: str = "doc_id", source: str = "source", text: str = "text", seed: int = SEED) -> DataFrame:
    """(id, source, body, tokens, weight, block, start, key): one row for
    each use of a document.  ``start`` counts the tokens before it in its
    block, ``key`` orders the block."""
    spark = docs.sparkSession
    rows = written(spark, measured(docs, id, source, text), "mix-rows")
    sources = written(spark, rows.groupBy("source").agg(F.sum("tokens").alias("tokens")), "mix-sources")
    total, n = sources.agg(F.sum("tokens")).first()[0] or 0, rows.count()
    sources = sources.withColumn("share", F.col("tokens") / F.lit(float(max(1, total))))
    if total:
        alpha, norm, budget = solve(sources.where("tokens > 0"), max_repeats, entropy, budget)
        weight = F.when(F.col("tokens") > 0, F.pow("share", F.lit(alpha)) / F.lit(math.exp(norm))).otherwise(0.0)
        repeats = F.when(F.col("tokens") > 0, weight * F.lit(budget) / F.col("tokens")).otherwise(1.0)
    else:
        weight, repeats = F.lit(0.0), F.lit(1.0)
    # weights within rounding of a whole number of blocks are whole
    sources = sources.select(F.col("source").alias("s"), F.col("tokens").alias("of"), weight.alias("weight"),
                             F.when(F.abs(repeats - F.round(repeats)) < 1e-9, F.round(repeats)).otherwise(repeats).alias("repeats"))
    uses = rows.join(sources, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    uses = uses.withColumn("block", F.explode(F.expr("sequence(0, cast(greatest(ceil(repeats), 1) as int) - 1)")))
    uses = uses.withColumn("key", F.xxhash64(F.lit(seed), "block", "id", "body"))
    ranges = max(1, -(-n // RANGE_ROWS))
    part = F.floor((F.col("key") / F.lit(2.0**64) + 0.5) * ranges).cast("long")
    uses = written(spark, uses.withColumn("part", part), "mix-uses")
    sums = uses.groupBy("source", "block", "part").agg(F.sum("tokens").alias("sum"))
    before = W.partitionBy("source", "block").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sums = written(spark, sums.select(
        F.col("source").alias("s"), F.col("block").alias("b"), F.col("part").alias("r"),
        F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("base")), "mix-ranges")
    inside = W.partitionBy("source", "block", "part").orderBy("key", "id", "body").rowsBetween(W.unboundedPreceding, -1)
    uses = uses.withColumn("within", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    uses = uses.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")) & (F.col("part") == F.col("r")))
    uses = uses.withColumn("start", F.col("base") + F.col("within"))
    ends = (F.col("repeats") - F.col("block")) * F.col("of")
    return uses.where((F.col("block") + 1 <= F.col("repeats")) | (F.col("start") < ends) | (F.col("of") == 0)).select(
        "id", "source", "body", "copies", "tokens", "weight", "block", "start", "key")


def mix(docs: DataFrame, max_repeats: float = MAX_REPEATS, entropy: float | None = None, budget: float | None = None,
        id: str = "doc_id", source: str = "source", text: str = "text", seed: int = SEED) -> DataFrame:
    """The rows of ``docs``, each as often as the mix uses it."""
    uses = plan(docs, max_repeats, entropy, budget, id, source, text, seed).select(
        F.col("id").alias("_id"), F.col("source").alias("_source"), F.col("body").alias("_body"))
    uses = written(docs.sparkSession, uses.groupBy("_id", "_source", "_body").agg(F.count(F.lit(1)).cast("int").alias("_uses")), "mix-plan")
    on = (docs[id].eqNullSafe(F.col("_id")) & docs[source].eqNullSafe(F.col("_source"))
          & (F.xxhash64(docs[text]) == F.col("_body")))
    # a shuffle join at every size: the plan has a row for each document
    return docs.join(uses.hint("merge"), on).withColumn("_use", F.explode(F.sequence(F.lit(1), F.col("_uses")))).select(
        *(docs[c] for c in docs.columns))
