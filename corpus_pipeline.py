"""The corpus pipeline: documents through five of the training-data operators.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet in the shared folder and read again as the next one's
input.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlane.llm import bpe, linededup, mixing, simhash, toxicity
from martlane.llm.base import importable, table, written
from martlane.llm.queries import bpe_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; the lexicon is learned from
    the training labels and the documents of ``sf_dir``."""
    lexicon = toxicity.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.score(docs, lexicon).where("predicted = 0").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without runs of 50 words or more that occur before; n_chars
    follows."""
    importable(spark)
    cut = linededup.dedup_lines(docs).select(*docs.columns)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return cut


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints: that of the
    smallest id."""
    importable(spark)
    return simhash.keep_one(docs, size=3, max_bits=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, and those of small sources again, up to the
    repetition limit."""
    return mixing.mix(docs, max_repeats=mixing.MAX_REPEATS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with n_tokens, token ids, and the hash of the text that
    the ids are decoded to."""
    importable(spark)
    return bpe.bpe(docs, bpe_path(), outputs=("n_tokens", "ids", "decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", keep_one_of_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: None: no SQL engine runs the lexicon, fingerprints and tokens of these
#: stages; tests compare them with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
