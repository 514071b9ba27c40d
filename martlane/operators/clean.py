"""Cleaning pipeline for the Orders / Returns / People extracts.

Steps run in the reference's order; the whole pipeline is one lazy plan.
Counters (duplicates dropped, negative quantities, bad discounts, missing
keys, unmatched regions, discounts nulled) ride along with ``df.observe`` and
are filled by whatever action writes the result, so they cost no extra pass.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from martlane.functions.dates import coerce_date
from martlane.functions.numeric import null_out_of_range, profit_margin, to_money, to_whole
from martlane.functions.text import fill_postal, normalize_column_name, normalize_flag, normalize_space
from martlane.schemas import CLEAN_SCHEMA, conform

# The default territory split (country, its eastern provinces,
# and the two region names) used by the reference.
DEFAULT_SPLIT_COUNTRY = "Canada"
DEFAULT_EASTERN_STATES = (
    "Ontario",
    "Quebec",
    "Nova Scotia",
    "New Brunswick",
    "Prince Edward Island",
    "Newfoundland and Labrador",
)
DEFAULT_INSIDE_REGION = "Eastern Canada"
DEFAULT_OUTSIDE_REGION = "Western Canada"
UNKNOWN = "Unknown"
MONEY_COLUMNS = ("sales", "discount", "profit", "shipping_cost")
DATE_COLUMNS = ("order_date", "ship_date")
WHOLE_COLUMNS = {"row_id": "bigint", "quantity": "int"}


# --------------------------------------------------------------------- C1
def normalize_columns(df: DataFrame) -> DataFrame:
    """Strip, lower-case, space/hyphen -> underscore in every header."""
    return df.toDF(*[normalize_column_name(c) for c in df.columns])


# --------------------------------------------------------------------- C2
def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Keep one of each group of rows equal in every column (NULL = NULL).

    A hash aggregate on all columns with map-side combine, so a value
    repeated millions of times collapses before the shuffle."""
    return df.dropDuplicates()


# --------------------------------------------------------------------- C3
def dedupe_people(people: DataFrame, order_by: str | list[str] | None = None) -> DataFrame:
    """One row per region, the first one in ``order_by`` order.

    Spark has no file order, so the order is a column (the reader's ``_seq``
    when present, else the person's name).  An aggregate (``min_by``), not a
    window: partial aggregation keeps a hot region cheap.
    """
    if order_by is None:
        order_by = ["_seq"] if "_seq" in people.columns else ["person"]
    elif isinstance(order_by, str):
        order_by = [order_by]
    rest = [c for c in people.columns if c != "region"]
    key = F.struct(*[F.col(c) for c in order_by], *[F.col(c) for c in rest if c not in order_by])
    first = F.min_by(F.struct(*[F.col(c) for c in rest]), key).alias("_first")
    return people.groupBy("region").agg(first).select("_first.*", "region").select(*people.columns)


# --------------------------------------------------------------- C4 C5 C6
def clean_counters(df: DataFrame) -> list:
    """C4, C5, C6 counters as aggregate expressions (for ``observe`` or ``agg``)."""
    qty = F.col("quantity").try_cast("double")
    disc = F.col("discount").try_cast("double")
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(qty < 0).alias("negative_quantity"),
        F.count_if((disc < 0) | (disc > 1)).alias("invalid_discount"),
        F.count_if(F.col("order_id").isNull()).alias("missing_order_id"),
    ]


def drop_missing_key(df: DataFrame, key: str = "order_id") -> DataFrame:
    """Drop rows whose key is NULL."""
    return df.dropna(subset=[key])


# --------------------------------------------------------------------- C7
def require_columns(df: DataFrame, cols: list[str] | tuple[str, ...], what: str = "Returns") -> DataFrame:
    """Schema guard (driver-side, on the plan's schema only)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"Invalid {what} extract format: missing {missing}")
    return df


# --------------------------------------------------------------------- C8
def attach_returns(orders: DataFrame, returns: DataFrame, dedupe: bool = False) -> DataFrame:
    """Left join the returns flag on order_id.

    Default keeps the reference's semantics: two return rows for one order
    double that order's lines.  ``dedupe=True`` first reduces returns to one
    row per order (any 'Yes' wins).  Returns grow with orders, so no
    broadcast hint: the planner broadcasts only when the measured side is
    small, and AQE splits a skewed order key.
    """
    require_columns(returns, ["order_id", "returned"])
    r = returns.select("order_id", "returned")
    if dedupe:
        r = r.groupBy("order_id").agg(
            F.when(F.max((normalize_flag("returned") == "Yes").cast("int")) == 1, "Yes")
            .otherwise("No").alias("returned")
        )
    base = orders.drop("returned") if "returned" in orders.columns else orders
    return base.join(r, "order_id", "left")


# --------------------------------------------------------------------- C9
def normalize_returned(df: DataFrame, column: str = "returned") -> DataFrame:
    """Returned -> 'Yes' / 'No' (NULL and anything else -> 'No')."""
    return df.withColumn(column, normalize_flag(column))


# -------------------------------------------------------------------- C10
def split_region(
    df: DataFrame,
    country: str = DEFAULT_SPLIT_COUNTRY,
    states: tuple[str, ...] | list[str] = DEFAULT_EASTERN_STATES,
    inside: str = DEFAULT_INSIDE_REGION,
    outside: str = DEFAULT_OUTSIDE_REGION,
) -> DataFrame:
    """Rows of ``country`` get region ``inside`` when their state is in
    ``states`` and ``outside`` otherwise (NULL state included)."""
    if "country" not in df.columns or "state" not in df.columns:
        return df
    in_country = F.col("country") == F.lit(country)
    return df.withColumn(
        "region",
        F.when(in_country & F.col("state").isin(*states), F.lit(inside))
        .when(in_country, F.lit(outside))
        .otherwise(F.col("region")),
    )


# ---------------------------------------------------------------- C11 C12
def attach_people(df: DataFrame, people: DataFrame, fill: bool = True) -> DataFrame:
    """Left join the territory owner on region; NULL regions match
    each other (as in pandas).  Unmatched -> 'Unknown' when ``fill``.
    When either side lacks a region column every row gets 'Unknown' (C12a).
    With one owner per region (C3) the people side is small and the planner
    broadcasts it by its measured size; else AQE splits a large region.
    """
    if "region" not in df.columns or "region" not in people.columns:
        return df.withColumn("person", F.lit(UNKNOWN))
    p = people.select(F.col("region").alias("_people_region"), F.col("person"))
    base = df.drop("person") if "person" in df.columns else df
    out = base.join(p, base["region"].eqNullSafe(p["_people_region"]), "left").drop("_people_region")
    if fill:
        out = out.withColumn("person", F.coalesce(F.col("person"), F.lit(UNKNOWN)))
    return out


def unmatched_regions(orders: DataFrame, people: DataFrame) -> DataFrame:
    """C12b report: regions of order lines with no territory owner -> (region, rows)."""
    p = people.select(F.col("region").alias("_people_region")).distinct()
    # lines are counted by region first, so one row per region meets people
    rows = orders.groupBy("region").agg(F.count(F.lit(1)).alias("rows"))
    return rows.join(p, rows["region"].eqNullSafe(p["_people_region"]), "left_anti")


def unmatched_of(cleaned: DataFrame) -> DataFrame:
    """C12b on a cleaned table: regions whose lines have no owner -> (region, rows)."""
    return cleaned.where(F.col("person") == UNKNOWN).groupBy("region").agg(F.count(F.lit(1)).alias("rows"))


# ---------------------------------------------------------------- C13 C14
def _date(c: str, dtype, formats: tuple[str, ...], by_column: dict | None):
    if by_column and c in by_column:  # the column's one format, none if it needs none
        return coerce_date(c, dtype, formats, by_column[c].formats)
    return coerce_date(c, dtype, formats)


def coerce_dates(df: DataFrame, columns: tuple[str, ...] = DATE_COLUMNS, formats: tuple[str, ...] = (),
                 by_column: dict | None = None) -> DataFrame:
    """Dates kept, serial numbers and text coerced, bad -> NULL.
    ``by_column``: what ``dates.column_formats`` found, one format a column."""
    types = {f.name: f.dataType for f in df.schema.fields}
    for c in columns:
        if c in types:
            df = df.withColumn(c, _date(c, types[c], formats, by_column))
    return df


def unreadable_counters(df: DataFrame, formats: tuple[str, ...] = (), by_column: dict | None = None) -> list:
    """Per typed column: values that are there but cannot be read, which the
    cleaning turns into NULL (aggregate expressions for ``observe``)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    read = {c: _date(c, types[c], formats, by_column) for c in DATE_COLUMNS if c in types}
    read |= {c: to_whole(c, kind) for c, kind in WHOLE_COLUMNS.items() if c in types}
    read |= {c: to_money(c) for c in MONEY_COLUMNS if c in types}
    return [F.count_if(F.col(c).isNotNull() & v.isNull()).alias(c) for c, v in read.items()]


# ------------------------------------------------------------ C15-C20
def clean_values(df: DataFrame, half_even: bool = False) -> DataFrame:
    """C15-C20 as one projection: postal codes, white space, money,
    line margin, discount range."""
    cols = set(df.columns)
    out = df
    if "postal_code" in cols:
        out = out.withColumn("postal_code", fill_postal("postal_code"))
    if "person" in cols:
        out = out.withColumn("person", normalize_space("person"))
    if "region" in cols:
        out = out.withColumn("region", normalize_space("region"))
    for c in MONEY_COLUMNS:
        if c in cols:
            out = out.withColumn(c, to_money(c, half_even=half_even))
    if "profit" in cols and "sales" in cols:
        out = out.withColumn("profit_margin", profit_margin("profit", "sales"))
    if "discount" in cols:
        out = out.withColumn("discount", null_out_of_range("discount", 0.0, 1.0))
    return out


# -------------------------------------------------------------------- C21
def shape_report(df: DataFrame) -> DataFrame:
    """One row (rows, columns)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


# -------------------------------------------------------------------- C22
@dataclass
class CleanReport:
    """Counters filled by the action that materialises the cleaned frame."""

    observations: dict[str, Observation] = field(default_factory=dict)

    def get(self) -> dict[str, int]:
        out: dict[str, int] = {}
        for name, obs in self.observations.items():
            for k, v in obs.get.items():
                out[f"{name}.{k}"] = v
        return out


def clean_orders(
    orders: DataFrame,
    returns: DataFrame,
    people: DataFrame,
    *,
    dedupe_returns: bool = False,
    people_order_by: str | list[str] | None = None,
    split_country: str = DEFAULT_SPLIT_COUNTRY,
    split_states: tuple[str, ...] | list[str] = DEFAULT_EASTERN_STATES,
    split_inside: str = DEFAULT_INSIDE_REGION,
    split_outside: str = DEFAULT_OUTSIDE_REGION,
    normalize_first: bool = False,
    half_even: bool = False,
    date_formats: tuple[str, ...] = (),
    column_formats: dict | None = None,
    report: CleanReport | None = None,
) -> DataFrame:
    """The whole cleaning pipeline -> cleaned ``raw_orders``.

    Output: the 24 order columns + returned ('Yes'/'No'), person,
    profit_margin, typed as ``schemas.CLEAN_SCHEMA``, then the extract's
    further columns as they are.  ``normalize_first``
    trims region white space before the people join (the reference trims
    after it, so padded regions get 'Unknown').  ``column_formats``: one
    format for each text date column, from ``dates.column_formats``.
    """
    orders, returns, people = (normalize_columns(x) for x in (orders, returns, people))
    if report is not None:
        obs_in = Observation("input")
        orders = orders.observe(obs_in, F.count(F.lit(1)).alias("rows"))
        report.observations["input"] = obs_in

    orders = drop_exact_duplicates(orders)
    if "region" in people.columns:
        people = dedupe_people(people, people_order_by)
    if report is not None:
        obs_dedup = Observation("deduped")
        orders = orders.observe(obs_dedup, *clean_counters(orders))
        report.observations["deduped"] = obs_dedup

    if "order_id" in orders.columns:
        orders = drop_missing_key(orders, "order_id")
    df = attach_returns(orders, returns, dedupe=dedupe_returns)
    df = normalize_returned(df)
    df = split_region(df, split_country, split_states, split_inside, split_outside)
    if normalize_first and "region" in df.columns:
        df = df.withColumn("region", normalize_space("region"))
        if "region" in people.columns:
            people = people.withColumn("region", normalize_space("region"))
    df = attach_people(df, people, fill=False)
    if report is not None:
        obs_people = Observation("people")
        df = df.observe(obs_people, F.count_if(F.col("person").isNull()).alias("unmatched_rows"))
        report.observations["people"] = obs_people
    df = df.withColumn("person", F.coalesce(F.col("person"), F.lit(UNKNOWN)))

    if report is not None:
        obs_read = Observation("unreadable")
        df = df.observe(obs_read, F.count(F.lit(1)).alias("rows"), *unreadable_counters(df, date_formats, column_formats))
        report.observations["unreadable"] = obs_read
    df = coerce_dates(df, formats=date_formats, by_column=column_formats)
    for c, kind in WHOLE_COLUMNS.items():
        if c in df.columns:
            df = df.withColumn(c, to_whole(c, kind))
    if report is not None:
        # Discounts outside [0, 1] after rounding: counted before C20 nulls them.
        rounded = to_money("discount", half_even=half_even)
        obs_disc = Observation("discount")
        df = df.observe(obs_disc, F.count_if(~rounded.between(0, 1)).alias("nulled"))
        report.observations["discount"] = obs_disc
    df = clean_values(df, half_even=half_even)
    return conform(df, CLEAN_SCHEMA, keep_extra=True)
