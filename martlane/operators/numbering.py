"""Dense row numbers without a single task: deal, count, add up.

Rows are dealt into ranges of a key and sorted inside them; a row's number is
its place in its range plus the rows of all ranges before, one figure for each
range.  The numbers 1..n follow the key, so they are the same after a rebuild
and however the input was split.  Rows of equal key are ordered by their other
columns, so a hot key too is dealt to several ranges; only rows equal in every
column can trade places.  NULLs come first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PLACE, RANGE = "_place", "_range"
_INSIDE = (1 << 33) - 1  # the lower bits of monotonically_increasing_id


def range_dealt(df: DataFrame, *key: str, ignore: tuple[str, ...] = (), ranges: int = 0) -> DataFrame:
    """``df`` in ranges of ``key``, with each row's range and place in it.

    To be written before ``dense_ids``: ranges come from a sample and differ
    from job to job.  ``ignore``: columns without a say, such as load stamps.
    ``ranges``: so many, where the session's shuffle partitions are fewer."""
    many = (ranges,) if ranges > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else ()
    order = [*key, *(c for c in df.columns if c not in (*key, *ignore))]
    return df.repartitionByRange(*many, *order).sortWithinPartitions(*order).withColumn(PLACE, F.monotonically_increasing_id())


def dense_ids(placed: DataFrame, name: str) -> DataFrame:
    """Replace the place of a written ``range_dealt`` frame by ids 1..n."""
    of = F.shiftright(PLACE, 33)
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    offsets = placed.groupBy(of.alias(RANGE)).agg(F.count(F.lit(1)).alias("n")).select(
        RANGE, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    joined = placed.withColumn(RANGE, of).join(F.broadcast(offsets), RANGE)  # as many rows as tasks of one stage
    number = F.col("offset") + F.col(PLACE).bitwiseAND(F.lit(_INSIDE)) + 1
    return joined.select(number.alias(name), *[c for c in placed.columns if c != PLACE])


#: Sampled rows a range, and at most.
SAMPLE, MOST_SAMPLED = 100, 1_000_000


def _bounds(df: DataFrame, order: list[str], ranges: int) -> list[tuple]:
    """The last row of every range but the last, by a sample of a bounded
    number of rows (the same for the same files)."""
    rows = df.count()
    if ranges < 2 or not rows:
        return []
    share = min(1.0, min(SAMPLE * ranges, MOST_SAMPLED) / rows)
    row = F.struct(*order)
    tiles = df.select(*order).sample(share, seed=1).withColumn(RANGE, F.ntile(ranges).over(Window.orderBy(*order)))
    last = tiles.groupBy(RANGE).agg(F.max(row).alias("last")).orderBy(RANGE).collect()
    return [tuple(r["last"]) for r in last[:-1]]


def _below(values: list[Column], x: Column) -> Column:
    """How many of the ascending ``values`` are below ``x`` (a binary search)."""
    steps = [1 << k for k in reversed(range(len(values).bit_length()))]
    array = F.array(*values)
    # a place beyond the end reads NULL, which is below nothing
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0),
                       lambda at, s: F.when(F.get(array, at + s - 1) < x, at + s).otherwise(at))


def _range_of(key: str, rest: list[str], schema: T.StructType, bounds: list[tuple]) -> Column:
    """The number of ``bounds`` before a row.  A key that is several bounds is
    parted by the rows' other columns, any other one lies in one range."""
    def lit(value, column: str) -> Column:
        return F.lit(value).cast(schema[column].dataType)

    by_key: dict = {}
    for k, *others in bounds:
        by_key.setdefault(k, []).append(others)
    k, other = F.col(key), F.struct(*rest)
    before, seen = [], 0  # bounds before each key that is one
    for parts in by_key.values():
        before.append(seen)
        seen += len(parts)
    before.append(seen)
    if None in by_key:  # first: no key is below NULL
        found = F.when(k.isNotNull(), 1 + _below([lit(v, key) for v in by_key if v is not None], k)).otherwise(0)
    else:
        found = _below([lit(v, key) for v in by_key], k) if by_key else F.lit(0)
    out = F.get(F.array(*[F.lit(n) for n in before]), found)
    for v, parts in by_key.items():
        if len(parts) > 1:
            structs = [F.struct(*[lit(x, c).alias(c) for x, c in zip(p, rest, strict=True)]) for p in parts]
            out = out + F.when(k.eqNullSafe(lit(v, key)), _below(structs, other)).otherwise(0)
    return out


def numbered(df: DataFrame, key: str, name: str, ranges: int, ignore: tuple[str, ...] = (),
             narrow: Callable[[DataFrame], DataFrame] = lambda x: x,
             wide: Callable[[DataFrame], DataFrame] = lambda x: x) -> DataFrame:
    """``df`` with dense ids 1..n, in ``ranges`` partitions sorted by ``key``.

    Where a range ends is fixed before any row is dealt, so its rows are
    counted first and numbered as they are sorted: what is written is final.
    ``df`` must give the same rows each time, as written tables do.  To the
    driver go the ranges' last rows and counts, a row a range.  Rows are dealt
    as ``narrow`` makes them and sorted as ``wide`` gives them back."""
    rest = [c for c in df.columns if c not in (key, *ignore)]
    order = [key, *rest]
    of = _range_of(key, rest, df.schema, _bounds(df, order, ranges))
    rows = {r[RANGE]: r["count"] for r in df.groupBy(of.alias(RANGE)).count().collect()}
    before = [0]
    for i in range(ranges - 1):
        before.append(before[-1] + rows.get(i, 0))
    dealt = wide(narrow(df.withColumn(RANGE, of)).repartitionById(ranges, F.col(RANGE))).drop(RANGE)
    dealt = dealt.sortWithinPartitions(*order).withColumn(PLACE, F.monotonically_increasing_id())
    offset = F.get(F.array(*[F.lit(n).cast("bigint") for n in before]), F.shiftright(PLACE, 33).cast("int"))
    return dealt.select((offset + F.col(PLACE).bitwiseAND(F.lit(_INSIDE)) + 1).alias(name), *df.columns)
