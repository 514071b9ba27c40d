"""One date format a column: scores, ties, values of another format."""

from __future__ import annotations

import datetime as dt

import pytest
from martlane.functions.dates import COLUMN_FORMATS, column_formats, format_shape, parse_text, text_number
from martlane.operators import clean as C
from pyspark.sql import functions as F


def read(spark, values):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "row_id int, order_date string")
    found = column_formats(df, ("order_date",))
    rows = C.coerce_dates(df, by_column=found).orderBy("row_id").collect()
    lost = df.agg(*C.unreadable_counters(df, by_column=found)).first().order_date
    return [r.order_date and r.order_date.date() for r in rows], found["order_date"], lost


def test_ambiguous_days_follow_their_column(spark):
    got, f, lost = read(spark, ["03/04/2014", "13/04/2014", "2014-05-06", "42000", None, " ", "soon", "Apr 3, 2014"])
    assert got[:4] == [dt.date(2014, 4, 3), dt.date(2014, 4, 13), dt.date(2014, 5, 6), dt.date(2014, 12, 27)] and got[4:] == [None] * 4
    assert (f.format, f.values, f.fits, f.other, f.unreadable, f.tied) == ("d/M/yyyy", 4, 2, 1, 1, ())
    assert lost == 3  # blank, unreadable, of another format
    got, f, _ = read(spark, ["03/04/2014", "04/13/2014"])
    assert got == [dt.date(2014, 3, 4), dt.date(2014, 4, 13)] and f.format == "M/d/yyyy"


def test_a_tie_is_told_and_month_first_wins(spark):
    got, f, _ = read(spark, ["03/04/2014", "1/2/2014"])
    assert got == [dt.date(2014, 3, 4), dt.date(2014, 1, 2)] and (f.format, f.tied) == ("M/d/yyyy", ("d/M/yyyy",))


@pytest.mark.parametrize("text,day", [("27-Dec-2014", 27), ("December 27, 2014", 27), ("12/27/14", 27), ("27/12/14", 27),
                                      ("27/12/2014 8:05", 27), ("Dec 9, 2014", 9), ("9 Dec 2014", 9)])
def test_formats_in_words_and_short_years(spark, text, day):
    got, f, lost = read(spark, [text])
    assert got == [dt.date(2014, 12, day)] and (f.fits, lost) == (1, 0)


def test_columns_that_need_no_format(spark):
    got, f, lost = read(spark, ["2014-05-06", "42000", None])
    assert got == [dt.date(2014, 5, 6), dt.date(2014, 12, 27), None] and (f.format, f.values, lost) == (None, 0, 0)
    assert read(spark, [])[1].format is None


SHAPES = ["1/2/2014", "13/4/2014", "4/13/2014", "00004/0013/2014", "0/1/2014", "-1/2/2014", "1/-2/2014", "+1/2/2014", "1/2/+12014",
          "1/2/12014", "1/2/14", "32/1/2014", "1/31/2014 8:05", "31/1/2014 23:59", "1/31/2014 8:5", "1-2-2014", "31-1-2014", "1--2-2014",
          "31-Jan-2014", "1 jan 2014", "Jan 1, 2014", "January 1, 2014", "MAY 5, 2014", "Sept 1, 2014", "2/30/2014", "1/2/2014\n",
          "1/2/201", "1/2/2014 ", "", "soon", "1/2/2014 x", "2014-01-02", "\u0661/2/2014", "1 / 2 / 2014", "-0/2/2014", "1/2/-2014"]


def test_a_format_is_only_tried_on_text_of_its_shape_and_reads_the_same(spark):
    df = spark.createDataFrame([(t,) for t in SHAPES], "t string")
    for f in COLUMN_FORMATS:
        assert format_shape(f), f
        plain = F.try_to_timestamp("t", F.lit(f))
        found = df.select("t", F.unix_micros(parse_text(F.col("t"), f)).alias("ours"),
                          F.unix_micros(plain).alias("plain")).collect()
        assert [(r.t, r.ours) for r in found] == [(r.t, r.plain) for r in found], f
        tried = df.where(F.col("t").rlike(format_shape(f)) & plain.isNull()).count()
        assert tried <= 3, (f, tried)  # 36 values, most of them of other formats
    assert format_shape("yyyyMMdd") is None and format_shape("yyyy'T'") is None


def test_numbers_are_told_from_dates_without_a_try(spark):
    texts = ["42000", " 42000.5 ", "1e-3", "-1E+5", "NaN", "-Infinity", "inf", "0x1p-3", "1d", "1/2/2014", "1,000", "31-12-2014", "8:05", "x", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = df.select("t", text_number(F.col("t")).alias("ours"), F.col("t").try_cast("double").alias("plain")).collect()
    assert [(r.t, repr(r.ours)) for r in found] == [(r.t, repr(r.plain)) for r in found]
