"""CSV records checked before they are parsed.

A spreadsheet cannot shift or lose a field; a CSV file can: an unquoted comma
adds a field, a cut line loses some, a lost quote swallows a line break, and a
wrong encoding breaks bytes.  Such records never reach the cleaning.  They
stand apart with their file and text, under the first reason that holds:

* ``bad_bytes``: no valid UTF-8
* ``unbalanced_quotes``: a quote that neither opens, closes nor is doubled
* ``too_many_fields``, ``too_few_fields``: other than the header has

Files are read by lines, so they can be split at any size.  Files whose quoted
fields hold line breaks need ``multi_line`` (one task per file); read by lines,
their broken records stand apart as well.  Blank lines are no records.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

REASONS = ("bad_bytes", "unbalanced_quotes", "too_many_fields", "too_few_fields")
#: Columns that a checked read adds: where a record stands, its text, and what
#: is wrong with it.
PLACE = ("_file", "_block", "_row")
RECORD, REASON = "_record", "_reason"

OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}
REPLACEMENT = "\ufffd"


def fault(text: Column, fields: int) -> Column:
    """Why a record cannot be read; NULL where it can."""
    # without doubled quotes, quoted fields hold none: what is left of the
    # record without quoted fields has neither quotes nor commas of its own
    bare = F.regexp_replace(F.replace(text, F.lit('""'), F.lit("")), '(?<![^,])"[^"]*+"(?![^,])', "")
    plain = F.when(text.contains('"'), bare).otherwise(text)  # most records have no quote
    found = F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit(""))) + 1
    return (F.when(~F.is_valid_utf8(text) | text.contains(REPLACEMENT), "bad_bytes")
            .when(plain.contains('"'), "unbalanced_quotes")
            .when(found > fields, "too_many_fields").when(found < fields, "too_few_fields"))


def _placed(df: DataFrame, *cols: Column | str) -> DataFrame:
    """Where each row stands: its file, the start of its split in the file and
    its number, which ascends inside a split - the order of the file, however
    Spark deals the splits to tasks."""
    return df.select(*cols, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                     F.monotonically_increasing_id().alias("_row"))


def csv_header(spark: SparkSession, path: str) -> list[str]:
    names = spark.read.options(header=True, quote='"', escape='"').csv(path).columns
    return [n.removeprefix("\ufeff") for n in names]


def csv_records(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Every record: the header's columns as text, ``PLACE``, ``RECORD`` and
    ``REASON`` (NULL for a sound one)."""
    names = csv_header(spark, path)
    schema = ", ".join(f"c{k} string" for k in range(len(names)))
    if multi_line:
        raw = spark.read.options(header=True, multiLine=True, columnNameOfCorruptRecord=RECORD, **OPTIONS)
        df = _placed(raw.schema(f"{schema}, {RECORD} string").csv(path), *(f"c{k}" for k in range(len(names))), RECORD)
        df = df.where(F.coalesce(F.trim(RECORD) != "", F.lit(True)))
        broken = F.greatest(*[F.coalesce(F.contains(f"c{k}", F.lit(REPLACEMENT)), F.lit(False)) for k in range(len(names))], F.lit(False))
        df = df.withColumn(REASON, F.when(F.col(RECORD).isNotNull(), F.coalesce(fault(F.col(RECORD), len(names)), F.lit("unbalanced_quotes")))
                           .when(broken, "bad_bytes"))
        df = df.withColumn(RECORD, F.coalesce(RECORD, F.when(broken, F.to_csv(F.struct(*(f"c{k}" for k in range(len(names))))))))
    else:
        lines = _placed(spark.read.text(path), F.col("value"))
        text = F.when(F.startswith("value", F.lit("\ufeff")), F.substring("value", 2, 1 << 30)).otherwise(F.col("value"))
        lines = lines.withColumn("value", text).where(F.trim("value") != "")
        df = lines.withColumn("v", F.from_csv("value", F.lit(schema), OPTIONS)).withColumn(REASON, fault(F.col("value"), len(names)))
        # a file's first line names the columns; no split but the first has it
        heads = [F.coalesce(F.col(f"v.c{k}").eqNullSafe(n), F.lit(False)) for k, n in enumerate(names)]
        df = df.where(~((F.col("_block") == 0) & F.least(*heads, F.lit(True))) | F.col(REASON).isNotNull())
        df = df.select("v.*", *PLACE, F.make_valid_utf8("value").alias(RECORD), REASON)
    return df.select(*(f"c{k}" for k in range(len(names))), *PLACE, RECORD, REASON).toDF(*names, *PLACE, RECORD, REASON)


def sound(records: DataFrame, malformed: str = "fail") -> DataFrame:
    """The sound records.  ``malformed``: 'fail' ends the job at the first
    other one, 'apart' leaves them to ``quarantine``."""
    if malformed == "apart":
        kept = records.where(F.col(REASON).isNull())
    elif malformed == "fail":
        told = F.concat(F.lit("malformed record ("), F.col(REASON), F.lit(") in "), F.col("_file"), F.lit(": "), F.col(RECORD))
        kept = records.where(F.when(F.col(REASON).isNull(), True).otherwise(F.raise_error(told).cast("boolean")))
    else:
        raise ValueError(f"malformed must be 'fail' or 'apart', not {malformed!r}")
    return kept.drop(RECORD, REASON)


def malformed_records(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """(file, reason, record) of the records that stand apart."""
    bad = csv_records(spark, path, multi_line).where(F.col(REASON).isNotNull())
    return bad.select(F.col("_file").alias("file"), F.col(REASON).alias("reason"), F.col(RECORD).alias("record"))


@dataclass
class Quarantine:
    """How many records were read, kept, and set apart for each reason."""

    read: int
    kept: int
    apart: dict[str, int]


def quarantine(spark: SparkSession, path: str, out: str, multi_line: bool = False) -> Quarantine:
    """Write the malformed records of ``path`` to ``out`` as Parquet; the
    counts are observed in that write."""
    seen = Observation("records")
    records = csv_records(spark, path, multi_line)
    records = records.observe(seen, F.count(F.lit(1)).alias("read"), F.count_if(F.col(REASON).isNull()).alias("kept"),
                              *[F.count_if(F.col(REASON) == r).alias(r) for r in REASONS])
    bad = records.where(F.col(REASON).isNotNull())
    bad.select(F.col("_file").alias("file"), F.col(REASON).alias("reason"), F.col(RECORD).alias("record")).write.mode("overwrite").parquet(out)
    got = seen.get
    return Quarantine(int(got["read"]), int(got["kept"]), {r: int(got[r]) for r in REASONS})
