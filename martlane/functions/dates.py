"""Date expressions: spreadsheet serial numbers, lenient coercion, month keys."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: day 0 of the Windows spreadsheet date system.
SERIAL_EPOCH = "1899-12-30 00:00:00"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Serials of 0001-01-01 and of the day after 9999-12-31: the dates there are.
FIRST_SERIAL, END_SERIAL = -693593.0, 2958466.0
# Tried in this order on text that is neither a number nor ISO: the month
# first, as the spreadsheet writes it, else the day first.
TEXT_FORMATS = ("M/d/yyyy", "d/M/yyyy", "M-d-yyyy", "d-M-yyyy", "M/d/yyyy H:mm", "d MMM yyyy", "MMM d, yyyy")


# What a field of a format accepts at most.  A try that fails costs an
# exception a value, so a format is tried only on text of its shape.
_FIELDS = {"yyyy": r"[-+]?\d{4,}", "yy": r"\d{2}", "MMMM": "[A-Za-z]+", "MMM": "[A-Za-z]+", "M": "0*(?:1[0-2]|[1-9])",
           "d": r"0*(?:[12]\d|3[01]|[1-9])", "H": r"\d+", "mm": r"\d{2}"}
# Text that is no number whatever else it is.
_NO_NUMBER = "[/,:]|[0-9]-"


def format_shape(fmt: str) -> str | None:
    """A pattern that every text read by ``fmt`` matches; None for formats
    with other fields, or with fields that no sign parts."""
    fields = re.split(r"([^A-Za-z'\[\]{}#]+)", fmt)
    if not all(f in _FIELDS for f in fields[::2]):
        return None
    return "^" + "".join(re.escape(f) if k % 2 else _FIELDS[f] for k, f in enumerate(fields)) + "$"


def parse_text(text: Column, fmt: str) -> Column:
    """``text`` read in ``fmt``, NULL where it cannot be."""
    read, shape = F.try_to_timestamp(text, F.lit(fmt)), format_shape(fmt)
    return F.when(text.rlike(shape), read) if shape else read


def text_number(text: Column) -> Column:
    """``text`` as a number, NULL where it is none."""
    return F.when(~text.rlike(_NO_NUMBER), text.try_cast("double"))


def serial_to_timestamp(c: Column | str) -> Column:
    """Spreadsheet serial (days since 1899-12-30, fraction = time of day) -> timestamp_ntz.

    Whole seconds; 42000.5 -> 2014-12-27 12:00:00.  NaN, infinity, text that
    is no number and days outside the years 1 to 9999 -> NULL.
    """
    days = _col(c).try_cast("double")
    days = F.when((days >= FIRST_SERIAL) & (days < END_SERIAL - 1e-5), days)
    seconds = F.round(days * F.lit(86400.0)).cast("bigint")
    return F.timestamp_add("SECOND", seconds, F.lit(SERIAL_EPOCH).cast("timestamp_ntz"))


def coerce_date(c: Column | str, dtype: T.DataType | None = None, formats: tuple[str, ...] = (),
                text_formats: tuple[str, ...] = TEXT_FORMATS) -> Column:
    """Lenient date coercion.

    Dates and timestamps are kept.  Text is tried in the caller's ``formats``
    first (for an extract with, say, yyyyMMdd); then numbers are spreadsheet
    serials; other text is parsed as an ISO timestamp or in one of
    ``text_formats``; anything unparsable -> NULL.  Numbers come before ISO
    text: parsing '42000' as text would yield year 42000.  With the one format
    of its column (``column_formats``) no value is read day first beside
    others month first.
    """
    col = _col(c)
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return col.cast("timestamp_ntz")
    as_text = col.cast("string")
    as_number = text_number(as_text)
    text = strip_or_null(as_text)

    def parsed(formats: tuple[str, ...]) -> list[Column]:
        return [parse_text(text, f).cast("timestamp_ntz") for f in formats]

    plain = F.when(as_number.isNotNull(), serial_to_timestamp(as_number)).otherwise(
        F.coalesce(text.try_cast("timestamp_ntz"), *parsed(text_formats)))
    return F.coalesce(*parsed(formats), plain) if formats else plain


# Formats a column can have as a whole; the first of those that fit equally
# many values wins.
COLUMN_FORMATS = (*TEXT_FORMATS, "d/M/yyyy H:mm", "M/d/yy", "d/M/yy", "d-MMM-yyyy", "MMMM d, yyyy")


@dataclass(frozen=True)
class ColumnFormat:
    """What one scan tells about a text date column: values that need a
    format (neither number nor ISO), the winning format and how many of them
    it reads, how many only another format reads, how many none reads, and
    the other formats that read as many as the winner."""

    format: str | None
    values: int
    fits: int
    other: int
    unreadable: int
    tied: tuple[str, ...]

    @property
    def formats(self) -> tuple[str, ...]:
        return (self.format,) if self.format else ()


def _needs_format(c: str) -> Column:
    text = strip_or_null(F.col(c).cast("string"))
    plain = text_number(text).isNotNull() | text.try_cast("timestamp_ntz").isNotNull()
    return F.when(~plain, text)


def format_scores(df: DataFrame, columns: tuple[str, ...], formats: tuple[str, ...] = COLUMN_FORMATS) -> DataFrame:
    """(column, format, fits, values, readable) from one aggregate over all
    rows: how many values each format reads, of those that need one, and how
    many any of them reads."""
    spread = df.select(*[_needs_format(c).alias(f"t{k}") for k, c in enumerate(columns)])
    # each value is read once in each format, then counted
    spread = spread.select("*", *[parse_text(F.col(f"t{k}"), f).isNotNull().alias(f"b{k}_{i}")
                                  for k in range(len(columns)) for i, f in enumerate(formats)])
    found, rows = [], []
    for k, c in enumerate(columns):
        reads = [F.col(f"b{k}_{i}") for i in range(len(formats))]
        found += [F.count_if(r).alias(f"n{k}_{i}") for i, r in enumerate(reads)]
        found += [F.count(f"t{k}").alias(f"v{k}"), F.count_if(F.coalesce(F.greatest(*reads, F.lit(False)), F.lit(False))).alias(f"r{k}")]
        rows += [F.struct(F.lit(c).alias("column"), F.lit(f).alias("format"), F.col(f"n{k}_{i}").alias("fits"),
                          F.col(f"v{k}").alias("values"), F.col(f"r{k}").alias("readable")) for i, f in enumerate(formats)]
    return spread.agg(*found).select(F.inline(F.array(*rows)))


def column_formats(df: DataFrame, columns: tuple[str, ...], formats: tuple[str, ...] = COLUMN_FORMATS) -> dict[str, ColumnFormat]:
    """The one format of each text date column (an action: one scan)."""
    out = {}
    scores = format_scores(df, columns, formats).collect()  # a row for each column and format
    for c in columns:
        own = {r.format: r for r in scores if r.column == c}
        fits = max(r.fits for r in own.values())
        best = [f for f in formats if own[f].fits == fits]
        any_row = own[formats[0]]
        out[c] = ColumnFormat(best[0] if fits else None, any_row["values"], fits, any_row.readable - fits,
                              any_row["values"] - any_row.readable, tuple(best[1:]) if fits else ())
    return out


def strip_or_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))

