"""Operator 2: quality by weak supervision, in DataFrame and SQL functions.

Each rule looks at counts of a text and votes good (1), bad (0) or abstains
(null).  Expectation-maximisation over the counts of vote patterns (at most 3
to the number of rules) estimates the share of good documents and, per rule,
how often it votes good for good and bad for bad documents; the posterior
probability of being good replaces the rule that all rules must pass.

Defined results: null text is the empty text, without words, which fails the
base rule; repeated rows repeat their result; on an empty table nothing is
estimated and nothing returned.  A result column replaces an input column of
the same name only in this function's own output, which holds the id and the
result columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlane.llm.base import SPACE_CLASS, written

WINDOW = 3
#: Up to so many repeated windows are looked up one by one; speed only.
FEW = 24
ROUNDS = 25
CLOSE = 1e-3
THRESHOLD = 0.5

#: name -> (bad where, good where), in SQL over the counts; else it abstains.
RULES = {
    "length": ("n_words < 10", "n_words >= 50"),
    "symbols": ("10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    "marks": ("100 * n_marks > 20 * word_chars", "100 * n_marks <= 10 * word_chars"),
    "symbol_words": ("10 * n_symbol_runs > n_words", "50 * n_symbol_runs <= n_words"),
    "repeats": ("100 * n_repeat_words > 50 * n_words", "100 * n_repeat_words <= 30 * n_words"),
    "runs": ("100 * n_run_words > 15 * n_words", "100 * n_run_words <= 5 * n_words"),
    "lines": ("100 * n_dup_lines > 50 * n_lines", "100 * n_dup_lines <= 10 * n_lines"),
    "word_size": ("word_chars < 2 * n_words or word_chars > 15 * n_words",
                  "word_chars between 3 * n_words and 12 * n_words"),
    "capitals": ("100 * n_capitals > 40 * word_chars", "100 * n_capitals <= 15 * word_chars"),
    "exclaims": ("4 * n_exclaims > n_words", "20 * n_exclaims <= n_words"),
}


def counts(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The id and the counts that rules look at, whole texts, no shuffle.

    Words in repeated windows: sorting the windows' hashes, plain numbers,
    shows those found twice or more.  A few of them are looked up window by
    window.  Where they are many, each window's hash gives way, in its low
    bits, to the window's place, so sorting brings equal windows together
    with their places, and neighbours whose whole hashes agree are repeated.
    Either way gives the same places, whose union of intervals is measured.
    """
    d = docs.select(F.col(id), F.coalesce(F.col(text), F.lit("")).alias("t"))
    d = d.select(
        id, "t", F.expr(f"array_remove(split(t, r'[{SPACE_CLASS}]+'), '')").alias("w"),
        F.expr(f"filter(split(t, '\\n'), x -> x rlike r'[^{SPACE_CLASS}]')").alias("l"))
    d = d.select(
        id, "w",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.expr("regexp_count(t, r'[#*$%&|<>]')").cast("long").alias("n_symbols"),
        F.expr("regexp_count(t, r'[^\\p{L}\\s]')").cast("long").alias("n_marks"),
        F.expr("regexp_count(t, r'[#*$%&|<>]+')").cast("long").alias("n_symbol_runs"),
        F.expr("regexp_count(t, '[A-Z]')").cast("long").alias("n_capitals"),
        F.expr("regexp_count(t, '!')").cast("long").alias("n_exclaims"),
        F.size("l").cast("long").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.expr("size(filter(w, (x, i) -> i > 0 and w[i - 1] = x))").cast("long").alias("n_run_words"),
        F.expr(f"if(size(w) >= {WINDOW}, transform(sequence(0, size(w) - {WINDOW}), "
               f"i -> xxhash64(w[i], w[i + 1], w[i + 2])), array())").alias("h"),
        F.expr("cast(ceil(log2(size(w) + 2)) as int)").alias("bits"))
    d = d.withColumn("o", F.sort_array("h"))
    d = d.withColumn("dup", F.expr("array_distinct(filter(o, (x, i) -> i > 0 and o[i - 1] = x))"))
    d = d.withColumn("s", F.expr(
        f"if(size(dup) > {FEW}, sort_array(transform(h, (x, i) -> shiftleft(x, bits) | i)), array())"))
    d = d.withColumn("mask", F.expr("shiftleft(1L, bits) - 1"))
    same = "h[cast(s[i {} 1] & mask as int)] = h[cast(x & mask as int)]"
    many = (f"sort_array(transform(filter(s, (x, i) -> (i > 0 and {same.format('-')}) or "
            f"(i < size(s) - 1 and {same.format('+')})), x -> x & mask))")
    few = "filter(transform(h, (x, i) -> if(array_contains(dup, x), cast(i as bigint), -1L)), i -> i >= 0)"
    d = d.withColumn("at", F.expr(f"if(size(dup) = 0, array(), if(size(dup) > {FEW}, {many}, {few}))"))
    repeated = f"aggregate(transform(at, (x, i) -> if(i = 0, {WINDOW}L, least({WINDOW}L, x - at[i - 1]))), 0L, (a, x) -> a + x)"
    return d.withColumn("n_repeat_words", F.expr(repeated)).drop("w", "h", "o", "dup", "s", "at", "bits", "mask")


def vote(rule: str) -> Column:
    bad, good = RULES[rule]
    return F.when(F.expr(bad), 0).when(F.expr(good), 1)


def likelihood(votes: list[str], parameters: dict[str, float]) -> Column:
    """Posterior probability of good, given the votes and the estimates."""
    def joint(prior: float, good: dict[str, float]) -> Column:
        out = F.lit(prior)
        for v in votes:
            out = out * F.when(F.col(v) == 1, F.lit(good[v])).when(F.col(v) == 0, F.lit(1 - good[v])).otherwise(F.lit(1.0))
        return out

    yes = joint(parameters["prior"], {v: parameters[f"{v}_good"] for v in votes})
    no = joint(1 - parameters["prior"], {v: 1 - parameters[f"{v}_bad"] for v in votes})
    return yes / (yes + no)


def estimate(patterns: DataFrame, votes: list[str]) -> dict[str, float]:
    """Expectation-maximisation over (votes..., n).  Every round is one
    aggregate over the bounded pattern table; only the estimates come back.
    A rule votes bad more often for bad documents than for good ones, which
    names the classes."""
    now = {"prior": 0.7} | {f"{v}_good": 0.99 for v in votes} | {f"{v}_bad": 0.3 for v in votes}
    for _ in range(ROUNDS):
        p, n = F.col("p"), F.col("n")
        scored = patterns.withColumn("p", likelihood(votes, now))
        sums = [F.sum(n * p).alias("yes"), F.sum(n).alias("all")]
        for v in votes:
            cast = F.col(v).isNotNull()
            sums += [F.sum(F.when(cast, n * p)).alias(f"{v}_yes"), F.sum(F.when(F.col(v) == 1, n * p)).alias(f"{v}_hit"),
                     F.sum(F.when(cast, n * (1 - p))).alias(f"{v}_no"), F.sum(F.when(F.col(v) == 0, n * (1 - p))).alias(f"{v}_miss")]
        r = scored.agg(*sums).first()
        if not r["all"]:
            return now
        held = lambda x, least, most: min(most, max(least, x))
        new = {"prior": held((r["yes"] + 1) / (r["all"] + 2), 0.05, 0.95)}
        for v in votes:
            good = held(((r[f"{v}_hit"] or 0) + 4) / ((r[f"{v}_yes"] or 0) + 4.1), 0.5, 0.999)
            new[f"{v}_good"] = good
            new[f"{v}_bad"] = held(((r[f"{v}_miss"] or 0) + 0.5) / ((r[f"{v}_no"] or 0) + 1), 1 - good + 0.01, 0.999)
        moved = max(abs(new[k] - now[k]) for k in now)
        now = new
        if moved < CLOSE:
            break
    return now


def assess(docs: DataFrame, threshold: float = THRESHOLD, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The id, all counts, the rules' votes (vote_<rule>), base_failed, the
    posterior probability of good quality and kept, for every row."""
    votes = [f"vote_{r}" for r in RULES]
    found = counts(docs, id, text).withColumns({f"vote_{r}": vote(r) for r in RULES})
    found = written(docs.sparkSession, found, "quality")
    patterns = written(docs.sparkSession, found.groupBy(*votes).agg(F.count(F.lit(1)).alias("n")).coalesce(1), "patterns")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return found.withColumn("base_failed", failed).withColumn(
        "quality", likelihood(votes, estimate(patterns, votes))).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
