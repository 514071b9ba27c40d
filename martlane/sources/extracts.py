"""Extract readers.

Extracts arrive as CSV (RFC 4180) or Parquet (the spreadsheet itself is not
parsed here).  Readers never infer a schema: CSV columns are read as text
and headers are normalised (C1).  Numbers stay text in one spelling per value
('5.0' and '5.00' become '5.000000'), so that exact duplicates are found and
the cleaning can count bad values before it turns them into NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlane.functions.dates import coerce_date
from martlane.functions.numeric import WIDE
from martlane.operators.clean import normalize_columns
from martlane.schemas import ORDERS_SCHEMA, PEOPLE_SCHEMA, RETURNS_SCHEMA
from martlane.sources.records import PLACE, _placed, csv_records, sound

DATE_COLUMNS = ("order_date", "ship_date")


NUMBERS = (T.LongType, T.IntegerType, T.DecimalType)


def _read_raw(spark: SparkSession, path: str, fmt: str, multi_line: bool = False, malformed: str = "fail",
              placed: bool = False) -> DataFrame:
    """CSV files are split and read by lines, and malformed records never come
    through (``sources.records``); ``multi_line`` lets quoted fields hold line
    breaks, at one task per file.  ``placed`` keeps each row's place."""
    if fmt == "csv":
        df = sound(csv_records(spark, path, multi_line), malformed)
        return df if placed else df.drop(*PLACE)
    if fmt == "parquet":
        df = spark.read.parquet(path)
        return _placed(df, "*") if placed else df
    raise ValueError(f"unsupported format {fmt!r}")


def _typed(df: DataFrame, schema: T.StructType, keep_text: tuple[str, ...] = (),
           formats: tuple[str, ...] = ()) -> DataFrame:
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name not in have:
            continue
        c = F.col(f.name)
        if f.name in keep_text:
            cols.append(c.cast("string").alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            # text dates, timestamps and spreadsheet serials (C13/C14 rules)
            src = {x.name: x.dataType for x in df.schema.fields}[f.name]
            cols.append(coerce_date(c, src, formats).cast("date").alias(f.name))
        elif isinstance(f.dataType, NUMBERS):
            text = isinstance({x.name: x.dataType for x in df.schema.fields}[f.name], T.StringType)
            cols.append(F.coalesce(c.try_cast(WIDE).cast("string"), c).alias(f.name) if text else c)
        else:
            cols.append(c.try_cast(f.dataType).alias(f.name))
    extra = [F.col(c) for c in df.columns if c not in {f.name for f in schema.fields}]
    return df.select(*cols, *extra)


def read_orders(spark: SparkSession, path: str, fmt: str = "csv", dates_as_string: bool = False,
                formats: tuple[str, ...] = (), multi_line: bool = False, malformed: str = "fail") -> DataFrame:
    """The Orders extract.

    ``dates_as_string=True`` is the fallback read: date columns stay text
    (spreadsheet serials, odd formats) and are coerced by the cleaning
    (C13/C14), which counts those it cannot read.  ``formats`` are date
    formats of the extract, tried before all others.  ``malformed``: what
    happens at a record that cannot be read ('fail', or 'apart': the caller
    writes them with ``records.quarantine``)."""
    df = normalize_columns(_read_raw(spark, path, fmt, multi_line, malformed))
    return _typed(df, ORDERS_SCHEMA, DATE_COLUMNS if dates_as_string else (), formats)


def read_returns(spark: SparkSession, path: str, fmt: str = "csv", multi_line: bool = False,
                 malformed: str = "fail") -> DataFrame:
    """The Returns extract (returned, order_id, region)."""
    return _typed(normalize_columns(_read_raw(spark, path, fmt, multi_line, malformed)), RETURNS_SCHEMA)


def read_people(spark: SparkSession, path: str, fmt: str = "csv", multi_line: bool = False,
                malformed: str = "fail") -> DataFrame:
    """S3: the People extract; ``_seq`` is the row's place for the
    first-per-region rule (C3): file name, place of the split in the file,
    order within the split - the same however splits are dealt to tasks."""
    df = _read_raw(spark, path, fmt, multi_line, malformed, placed=True)
    df = df.withColumn("_seq", F.struct(*PLACE)).drop(*PLACE)
    return _typed(normalize_columns(df), PEOPLE_SCHEMA)


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """Scan the cleaned Parquet output."""
    return spark.read.parquet(path)


def source_row_count(spark: SparkSession, path: str, fmt: str = "parquet") -> int:
    """The input must exist; its row count (Parquet: footers only)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        raise FileNotFoundError(path)
    return _read_raw(spark, path, fmt).count()


def source_row_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """S17 as a table: (table_name, rows) for each input, every path checked
    to exist first.  Counts come from Parquet footers (no column is read)."""
    parts = []
    for name, path in paths.items():
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            raise FileNotFoundError(path)
        parts.append(spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"))
                     .select(F.lit(name).alias("table_name"), "rows"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
