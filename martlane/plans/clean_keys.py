"""Query keys for the cleaning rules (C2-C22), run over the Orders extract
or its seeded-dirt variant (every row of it; see ``sources.driver``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlane.functions.dates import coerce_date, serial_to_timestamp
from martlane.functions.numeric import null_out_of_range, profit_margin, to_money, to_whole
from martlane.functions.text import fill_postal, normalize_space
from martlane.operators import clean as C
from martlane.plans.extract_store import extracts_for
from martlane.sources.driver import dirty_people, supplier_people

# Region-split parameters that fit the driver data (FIXTURES.md §2).
SPLIT = dict(country="AMERICA", states=("NATION_1", "NATION_6"), inside="Eastern America", outside="Western America")


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracts_for(spark, sf_dir, dirty=True).orders


def orders_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracts_for(spark, sf_dir).orders


def returns_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracts_for(spark, sf_dir).returns


def people_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracts_for(spark, sf_dir).people


def _doubles(df: DataFrame) -> DataFrame:
    from martlane.plans.registry import comparable

    return comparable(df)


def dedupe_exact(spark, sf_dir):
    return C.drop_exact_duplicates(_dirty(spark, sf_dir))


def dedupe_people(spark, sf_dir):
    return C.dedupe_people(supplier_people(spark, sf_dir), "_seq").select("person", "region")


def clean_counters(spark, sf_dir):
    deduped = C.drop_exact_duplicates(_dirty(spark, sf_dir))
    return deduped.agg(*C.clean_counters(deduped))


def drop_missing_key(spark, sf_dir):
    return C.drop_missing_key(_dirty(spark, sf_dir), "order_id")


def attach_returns(spark, sf_dir):
    return _doubles(C.attach_returns(orders_extract(spark, sf_dir), returns_extract(spark, sf_dir)))


def attach_returns_dedupe(spark, sf_dir):
    return _doubles(C.attach_returns(orders_extract(spark, sf_dir), returns_extract(spark, sf_dir), dedupe=True))


def normalize_returned(spark, sf_dir):
    df = C.attach_returns(orders_extract(spark, sf_dir), returns_extract(spark, sf_dir))
    return C.normalize_returned(df).select("row_id", "order_id", "returned")


def split_region(spark, sf_dir):
    return C.split_region(orders_extract(spark, sf_dir), **SPLIT).select("row_id", "country", "state", "region")


def attach_people(spark, sf_dir):
    df = C.attach_people(orders_extract(spark, sf_dir), C.dedupe_people(people_extract(spark, sf_dir)))
    return df.select("row_id", "region", "person")


def unmatched_regions(spark, sf_dir):
    return C.unmatched_regions(orders_extract(spark, sf_dir), dirty_people(people_extract(spark, sf_dir)))


def attach_people_defects(spark, sf_dir):
    """Lines of a region whose owner is misspelt get 'Unknown'."""
    df = C.attach_people(orders_extract(spark, sf_dir), C.dedupe_people(dirty_people(people_extract(spark, sf_dir))))
    return df.select("row_id", "region", "person")


def attach_people_no_region(spark, sf_dir):
    """A People extract without a region column."""
    df = C.attach_people(orders_extract(spark, sf_dir), people_extract(spark, sf_dir).drop("region"))
    return df.select("row_id", "region", "person")


def hard_values(spark, sf_dir):
    """C5, C13, C14, C18, C20 and the reader's number rules on every line of
    the extract, rewritten with values that overflow, spell numbers otherwise
    or use other date formats."""
    o = orders_extract(spark, sf_dir)
    rid = F.col("row_id")

    def spell(n: int, *texts):
        out = None
        for k, text in enumerate(texts):
            c = F.col(text[1:]).cast("string") if text.startswith("=") else F.lit(text)
            out = F.when(rid % n == k, c) if out is None else out.when(rid % n == k, c)
        return out

    d = F.col("order_date")
    date = (F.when(rid % 8 == 0, F.date_format(d, "M/d/yyyy")).when(rid % 8 == 1, F.date_format(d, "yyyy-MM-dd"))
            .when(rid % 8 == 2, F.lit("1e300")).when(rid % 8 == 3, F.lit("99999999999")).when(rid % 8 == 4, F.lit("NaN"))
            .when(rid % 8 == 5, F.concat(F.lit("31-"), F.date_format(d, "MM-yyyy"))).when(rid % 8 == 6, F.lit("soon"))
            .otherwise(F.date_diff(d, F.lit("1899-12-30").cast("date")).cast("string")))
    t = o.select(
        "row_id",
        spell(6, "1000000000000.00", "999999999999999.995", "1e20", "N/A", "=sales", "1e3").alias("sales"),
        spell(5, "150", "7", "-0.5", "0.25", "=discount").alias("discount"),
        spell(4, "3.0", "2.5", "99999999999", "=quantity").alias("quantity"), date.alias("order_date"))
    return _doubles(t.select(
        "row_id", to_money("sales").alias("sales"), to_money("discount").alias("discount"),
        null_out_of_range(to_money("discount"), 0.0, 1.0).alias("discount_in_range"),
        to_whole("quantity", "int").cast("double").alias("quantity"), coerce_date("order_date").cast("date").cast("string").alias("order_date")))


def unreadable_values(spark, sf_dir):
    """Per column: values of the dirty extract that cannot be read."""
    d = _dirty(spark, sf_dir)
    return d.agg(*C.unreadable_counters(d))


def _through_csv(spark, df: DataFrame, name: str) -> str:
    """Write an extract as compressed CSV with spreadsheet headers; returns its
    folder."""
    from martlane.plans.warehouse import fresh_root
    from martlane.sources.sinks import write_csv

    path = f"{fresh_root(spark)}/{name}"
    heads = {c: c.replace("_", " ").title() for c in df.columns} | {"sub_category": " Sub-Category "}
    write_csv(df.toDF(*[heads[c] for c in df.columns]), path, compression="gzip")
    return path


def read_orders_csv(spark, sf_dir):
    """The Orders extract written as CSV and read again."""
    from martlane.schemas import ORDERS_SCHEMA, conform
    from martlane.sources.extracts import read_orders

    back = read_orders(spark, _through_csv(spark, orders_extract(spark, sf_dir), "orders"), multi_line=False)
    whole = {c: to_whole(c, kind) for c, kind in C.WHOLE_COLUMNS.items()}
    return _doubles(conform(back.withColumns(whole | {c: to_money(c) for c in C.MONEY_COLUMNS}), ORDERS_SCHEMA))


def read_returns_csv(spark, sf_dir):
    """The Returns extract written as CSV and read again."""
    from martlane.sources.extracts import read_returns

    return read_returns(spark, _through_csv(spark, returns_extract(spark, sf_dir), "returns"), multi_line=False)


def read_people_csv(spark, sf_dir):
    """An extract of many owners per region written as CSV files
    in supplier order and read again; the first of each region."""
    from martlane.sources.extracts import read_people

    people = supplier_people(spark, sf_dir).repartitionByRange("_seq").sortWithinPartitions("_seq").drop("_seq")
    return C.dedupe_people(read_people(spark, _through_csv(spark, people, "people"))).select("person", "region")


def _with_breaks(spark, sf_dir) -> str:
    """The Orders extract as CSV lines, some of them broken; its folder."""
    from martlane.plans.warehouse import fresh_root

    o = orders_extract(spark, sf_dir)
    rid, line = F.col("row_id"), F.to_csv(F.struct(*o.columns), {"escape": '"'})
    text = (F.when(rid % 37 == 1, F.concat(line, F.lit(",one more"))).when(rid % 41 == 2, F.regexp_replace(line, ",[^,]*$", ""))
            .when(rid % 43 == 3, F.concat(F.lit('"'), line)).when(rid % 47 == 4, F.concat(line, F.expr("CAST(X'C3' AS STRING)")))
            .otherwise(line))
    head = F.lit(",".join(o.columns))
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0  # of each file
    lines = o.select(text.alias("line"), first.alias("first"))
    path = f"{fresh_root(spark)}/broken"
    lines.select(F.explode(F.when(F.col("first"), F.array(head, "line")).otherwise(F.array("line"))).alias("value")).write.text(path)
    return path


def quarantined_records(spark, sf_dir):
    """The records of a broken extract that stand apart, and why."""
    from martlane.sources.records import malformed_records

    bad = malformed_records(spark, _with_breaks(spark, sf_dir))
    return bad.select(F.regexp_extract("record", r"(\d+)", 1).cast("long").alias("row_id"), "reason")


def kept_records(spark, sf_dir):
    """The other records of that extract, all values in their columns."""
    from martlane.schemas import ORDERS_SCHEMA, conform
    from martlane.sources.extracts import read_orders

    back = read_orders(spark, _with_breaks(spark, sf_dir), malformed="apart")
    whole = {c: to_whole(c, kind) for c, kind in C.WHOLE_COLUMNS.items()}
    return _doubles(conform(back.withColumns(whole | {c: to_money(c) for c in C.MONEY_COLUMNS}), ORDERS_SCHEMA))


def excel_serial_dates(spark, sf_dir):
    return _dirty(spark, sf_dir).select("row_id", serial_to_timestamp("order_date").alias("order_ts"))


def coerce_dates(spark, sf_dir):
    d = _dirty(spark, sf_dir)
    types = {f.name: f.dataType for f in d.schema.fields}
    return d.select(
        "row_id",
        coerce_date("order_date", types["order_date"]).alias("order_date"),
        coerce_date("ship_date", types["ship_date"]).alias("ship_date"),
    )


def _text_dates(spark, sf_dir) -> DataFrame:
    """The Orders extract with order dates written day first and ship dates
    month first, some of them in words or unreadable."""
    o, rid = orders_extract(spark, sf_dir), F.col("row_id")
    day_first = F.when(rid % 2 == 0, F.date_format("order_date", "dd/MM/yyyy")).otherwise(F.date_format("order_date", "d/M/yyyy"))
    return o.select(
        "row_id", F.when(rid % 50 == 0, F.date_format("order_date", "MMM d, yyyy")).when(rid % 53 == 1, "soon").otherwise(day_first)
        .alias("order_date"),
        F.when(rid % 59 == 2, F.col("ship_date").cast("string")).otherwise(F.date_format("ship_date", "M/d/yyyy")).alias("ship_date"))


def column_dates(spark, sf_dir):
    """C14: every value read in the one format of its column."""
    from martlane.functions.dates import column_formats

    d = _text_dates(spark, sf_dir)
    read = C.coerce_dates(d, by_column=column_formats(d, C.DATE_COLUMNS))
    return read.select("row_id", *[F.col(c).cast("date").alias(c) for c in C.DATE_COLUMNS])


def date_format_scores(spark, sf_dir):
    """C14: how many values of each column each format reads."""
    from martlane.functions.dates import format_scores

    return format_scores(_text_dates(spark, sf_dir), C.DATE_COLUMNS)


def partitioned_orders(spark, sf_dir):
    """The cleaned lines written in folders by year; later years only,
    so that the scan leaves the other folders out."""
    from martlane.plans.warehouse import fresh_root, star_for
    from martlane.sources.sinks import write_by_year

    path = f"{fresh_root(spark)}/by_year"
    write_by_year(star_for(spark, sf_dir).raw_orders, path)
    late = spark.read.parquet(path).where("order_year >= 1996")
    return _doubles(late.groupBy("order_year", "region").agg(F.count(F.lit(1)).alias("rows"), F.sum("sales").alias("revenue")))


def mart_file(spark, sf_dir):
    """The KPI mart exported as one named CSV file and read again."""
    from martlane.operators.marts import kpi_overview
    from martlane.plans.warehouse import fresh_root, star_for
    from martlane.sources.sinks import export_mart

    kpi, path = kpi_overview(star_for(spark, sf_dir).fact_sales), f"{fresh_root(spark)}/kpi_overview.csv"
    export_mart(kpi, path, bounded=True)
    return spark.read.schema(kpi.schema).option("header", True).csv(path)


def fill_postal_key(spark, sf_dir):
    return orders_extract(spark, sf_dir).select("row_id", fill_postal("postal_code").alias("postal_code"))


def normalize_space_key(spark, sf_dir):
    return _dirty(spark, sf_dir).select("row_id", normalize_space("region").alias("region"))


def to_money_key(spark, sf_dir):
    return _doubles(_dirty(spark, sf_dir).select(
        "row_id", *[to_money(c).alias(c) for c in C.MONEY_COLUMNS]))


def line_profit_margin(spark, sf_dir):
    d = _dirty(spark, sf_dir).select("row_id", to_money("profit").alias("profit"), to_money("sales").alias("sales"))
    return d.select("row_id", profit_margin("profit", "sales").alias("profit_margin"))


def null_bad_discount(spark, sf_dir):
    d = _dirty(spark, sf_dir).select("row_id", to_money("discount").alias("discount"))
    return _doubles(d.select("row_id", null_out_of_range("discount", 0.0, 1.0).alias("discount")))


def clean_orders(spark, sf_dir):
    return _doubles(C.clean_orders(_dirty(spark, sf_dir), returns_extract(spark, sf_dir), people_extract(spark, sf_dir)))


def shape_report(spark, sf_dir):
    return C.shape_report(
        C.clean_orders(_dirty(spark, sf_dir), returns_extract(spark, sf_dir), people_extract(spark, sf_dir)))


CLEAN_QUERIES = {
    "read_orders_csv": read_orders_csv,
    "read_returns_csv": read_returns_csv,
    "read_people_csv": read_people_csv,
    "quarantined_records": quarantined_records,
    "kept_records": kept_records,
    "dedupe_exact": dedupe_exact,
    "dedupe_people": dedupe_people,
    "clean_counters": clean_counters,
    "drop_missing_key": drop_missing_key,
    "attach_returns": attach_returns,
    "attach_returns_dedupe": attach_returns_dedupe,
    "normalize_returned": normalize_returned,
    "split_region": split_region,
    "attach_people": attach_people,
    "unmatched_regions": unmatched_regions,
    "attach_people_defects": attach_people_defects,
    "attach_people_no_region": attach_people_no_region,
    "hard_values": hard_values,
    "unreadable_values": unreadable_values,
    "excel_serial_dates": excel_serial_dates,
    "coerce_dates": coerce_dates,
    "column_dates": column_dates,
    "date_format_scores": date_format_scores,
    "partitioned_orders": partitioned_orders,
    "mart_file": mart_file,
    "fill_postal": fill_postal_key,
    "normalize_space": normalize_space_key,
    "to_money": to_money_key,
    "line_profit_margin": line_profit_margin,
    "null_bad_discount": null_bad_discount,
    "clean_orders": clean_orders,
    "shape_report": shape_report,
}
