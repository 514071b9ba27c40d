"""Clean -> load -> build, materialised as Parquet tables.

The reference cleans once, writes a Parquet file, loads it and builds the
star with CTAS statements; reports then read the built tables.  Same here:
``build_warehouse`` runs the cleaning plan once (its full-row shuffles are
the exact-duplicate drop and the returns join on the order key), writes
``raw_orders``, builds every dimension and
the fact from the *written* table and writes them too.  Written tables cut
the lineage (a lost executor costs a task retry, not a re-clean) and every
report starts from a column-pruned Parquet scan.

``star_for`` writes each table when a query first asks for it (a report on
``raw_orders`` does not wait for the fact's numbering); ``build_warehouse``,
``build_from_clean`` and ``star_for(whole=True)`` write them all.

Location: a folder under ``spark.checkpoint.dir`` (shared storage on a
cluster), or any path the caller gives.
"""

from __future__ import annotations

import hashlib
import os
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from martlane.operators.clean import CleanReport, clean_orders
from martlane.operators.numbering import numbered
from martlane.operators.star import (
    CUSTOMER_DISTINCT_COLS, CUSTOMER_KEY_COLS, PRODUCT_COLS, Star, build_fact_sales, build_star, created_at,
    dim_people_of, latest_per_key, narrow_fact, versions, wide_fact,
)
from martlane.session import checkpoint_root, input_bytes
from martlane.sources.catalog import create_database, point_to
from martlane.sources.driver import Extracts, defective_orders

TABLES = [
    "raw_orders", "raw_returns", "raw_people", "dim_date", "dim_customer", "dim_customer_key",
    "dim_product", "dim_product_key", "dim_people", "fact_sales",
]
# written last: a folder without it is no finished warehouse
COMPLETE = "_complete"
RAW_PLACE = "raw_orders_place"
#: A dimension by key, whose versions are written beside it: its columns, the
#: dimension of distinct rows that can start from them too, and its columns.
VERSIONED = {"dim_customer_key": (CUSTOMER_KEY_COLS, "dim_customer", CUSTOMER_DISTINCT_COLS),
             "dim_product_key": (PRODUCT_COLS, "dim_product", PRODUCT_COLS)}
#: Bytes of ``raw_orders`` a range of the fact; its rows take about eight times that.
RANGE_BYTES = 16 << 20

_MEMO: dict[tuple, Star] = {}
_NAMED: dict[tuple, Star] = {}
_LOCK = threading.Lock()


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def open_warehouse(spark: SparkSession, root: str) -> Star:
    """Read a written warehouse back (every table a Parquet scan)."""
    return Star(**{t: spark.read.parquet(table_path(spark, root, t)) for t in TABLES}, root=root)


def publish(spark: SparkSession, root: str, database: str) -> None:
    """Make the tables of a finished warehouse catalog tables of ``database``,
    over the written files (nothing is copied).  An unfinished one is refused,
    so a failed build leaves the tables of the build before."""
    if not is_complete(spark, root):
        raise ValueError(f"no finished warehouse: {root}")
    create_database(spark, database)
    for t in TABLES:
        point_to(spark, f"{database}.{t}", table_path(spark, root, t))


def table_path(spark: SparkSession, root: str, table: str) -> str:
    """Where ``table`` lies; a warehouse built from a cleaned file keeps that
    file as its ``raw_orders`` and only notes its place."""
    path = f"{root}/{table}"
    if table == "raw_orders" and not _exists(spark, path) and _exists(spark, f"{root}/{RAW_PLACE}"):
        return spark.read.parquet(f"{root}/{RAW_PLACE}").first().path
    return path


def existing_tables(spark: SparkSession, root: str, names: tuple[str, ...]) -> dict[str, DataFrame | None]:
    """The tables of a warehouse by name, None for those that are missing."""
    paths = {n: table_path(spark, root, n) for n in names}
    return {n: spark.read.parquet(p) if _exists(spark, p) else None for n, p in paths.items()}


def is_complete(spark: SparkSession, root: str) -> bool:
    return _exists(spark, f"{root}/{COMPLETE}")


def build_warehouse(
    spark: SparkSession,
    extracts: Extracts,
    root: str,
    report: CleanReport | None = None,
    max_parallel_writes: int = 4,
    **clean_options,
) -> Star:
    raw = clean_orders(extracts.orders, extracts.returns, extracts.people, report=report, **clean_options)
    _write(raw, f"{root}/raw_orders")
    return build_from_clean(spark, spark.read.parquet(f"{root}/raw_orders"), root, max_parallel_writes,
                            written=True)


def build_from_clean(
    spark: SparkSession, raw: DataFrame, root: str, max_parallel_writes: int = 4, written: bool = False,
    raw_path: str | None = None
) -> Star:
    """Load + build from a cleaned ``raw_orders`` frame: write it to
    ``root/raw_orders`` (skipped when ``written``, i.e. it already is that
    table, or when it is the file ``raw_path``, which is then noted instead
    of copied), then build and write the star from the written table."""
    if raw_path is not None:
        _write(spark.createDataFrame([(raw_path,)], "path string").coalesce(1), f"{root}/{RAW_PLACE}")
    elif not written:
        _write(raw, f"{root}/raw_orders")
        raw = spark.read.parquet(f"{root}/raw_orders")
    _write_rest(spark, root, build_star(raw), [t for t in TABLES if t != "raw_orders"], max_parallel_writes)
    return open_warehouse(spark, root)


def _write_table(spark: SparkSession, root: str, name: str, star: Star) -> None:
    """One table of ``star``, whose ``raw_orders`` is the written one."""
    if name == "fact_sales":
        numbered_fact(spark, root, star)
    elif name == "dim_people":
        # the same aggregate as raw_people, so it starts from the written one
        _write(dim_people_of(spark.read.parquet(f"{root}/raw_people")), f"{root}/dim_people")
    elif name in VERSIONED:
        cols, *_ = VERSIONED[name]
        found = f"{root}/{name}_versions"
        _write(versions(star.raw_orders, cols), found)
        _write(latest_per_key(spark.read.parquet(found), cols).select("*", created_at()), f"{root}/{name}")
    else:
        _write(getattr(star, name), f"{root}/{name}")


def _write_distinct(spark: SparkSession, root: str, keyed: str) -> None:
    """The dimension of distinct rows from the written versions of the one by
    key, which hold them all: the lines are not grouped again."""
    _, name, cols = VERSIONED[keyed]
    found = spark.read.parquet(f"{root}/{keyed}_versions")
    _write(found.select(*cols).distinct().select("*", created_at()), f"{root}/{name}")


def numbered_fact(spark: SparkSession, root: str, star: Star) -> DataFrame:
    """The written fact, with a dense sales_id in the order of the row key and
    a file for each range: its rows are dealt and written once."""
    size = input_bytes(spark, table_path(spark, root, "raw_orders"))
    # as many as the size asks for; smaller ones only to give each core some
    ranges = max(1, -(-size // RANGE_BYTES), min(spark.sparkContext.defaultParallelism, size // (RANGE_BYTES >> 4)))
    fact = build_fact_sales(star.raw_orders, with_sales_id=False).drop("created_at")
    fact = numbered(fact, "row_id", "sales_id", ranges, narrow=narrow_fact, wide=wide_fact)
    _write(fact.select("*", created_at()), f"{root}/fact_sales")
    return spark.read.parquet(f"{root}/fact_sales")


def _write_rest(spark: SparkSession, root: str, star: Star, names: list[str], max_parallel_writes: int = 4) -> None:
    """The tables ``names`` of ``star``, then the marker of a whole warehouse."""
    # The staging derivations and dimensions are independent aggregates of
    # the written table: submit them as concurrent jobs so small ones fill
    # the cluster beside the big ones.
    shared = {keyed: name for keyed, (_, name, _) in VERSIONED.items() if {keyed, name} <= {*names}}
    last = [n for n in ("dim_people", "fact_sales") if n in names]
    with ThreadPoolExecutor(max_workers=max_parallel_writes) as pool:
        for f in [pool.submit(_write_table, spark, root, n, star) for n in names if n not in (*last, *shared.values())]:
            f.result()
        for f in [pool.submit(_write_distinct, spark, root, keyed) for keyed in shared]:
            f.result()
    for n in last:
        _write_table(spark, root, n, star)
    for keyed in VERSIONED:
        _drop(spark, f"{root}/{keyed}_versions")
    _write(spark.range(1).coalesce(1), f"{root}/{COMPLETE}")


class GradualStar(Star):
    """A warehouse at ``root`` whose tables are written when first asked for,
    ``raw_orders`` from the frame ``raw``, the others from the written one;
    ``finish`` writes the rest and the marker."""

    def __init__(self, root: str, raw: DataFrame | None = None, **tables: DataFrame):
        self.__dict__.update(tables, root=root, _raw=raw, _lock=threading.RLock())

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        with self._lock:
            if name not in self.__dict__:
                spark = self._raw.sparkSession
                if name == "raw_orders":
                    _write(self._raw, f"{self.root}/raw_orders")
                else:
                    if name == "dim_people":
                        self.raw_people  # noqa: B018 - written first
                    keyed = f"{name}_key"
                    if keyed in VERSIONED and keyed in self.__dict__ and _exists(spark, f"{self.root}/{keyed}_versions"):
                        _write_distinct(spark, self.root, keyed)
                    else:
                        _write_table(spark, self.root, name, build_star(self.raw_orders))
                self.__dict__[name] = spark.read.parquet(f"{self.root}/{name}")
            return self.__dict__[name]

    def finish(self) -> Star:
        with self._lock:
            raw = self.raw_orders
            if not is_complete(raw.sparkSession, self.root):
                _write_rest(raw.sparkSession, self.root, build_star(raw), [t for t in TABLES if t not in self.__dict__])
        return self

    def tables(self) -> dict[str, DataFrame]:
        return {t: getattr(self, t) for t in TABLES}


DRIVER_TABLES = ("lineitem", "orders", "customer", "part", "supplier", "nation", "region")


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs_path(spark, path)
    return fs.exists(p)


def _drop(spark: SparkSession, path: str) -> None:
    p, fs = _fs_path(spark, path)
    fs.delete(p, True)


def input_tag(spark: SparkSession, sf_dir: str) -> str:
    """Fingerprint of the inputs: path, length and modification time of every
    file of every driver table, nested folders included."""
    h = hashlib.sha1(sf_dir.encode())
    for t in DRIVER_TABLES:
        p, fs = _fs_path(spark, f"{sf_dir.rstrip('/')}/{t}.parquet")
        if fs.exists(p):
            found, files = [], fs.listFiles(p, True)
            while files.hasNext():
                st = files.next()
                found.append(f"{st.getPath()}:{st.getLen()}:{st.getModificationTime()}")
            h.update("\n".join([t, *sorted(found)]).encode())
    return h.hexdigest()[:16]


def input_key(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    return spark.sparkContext.applicationId, os.path.abspath(sf_dir), input_tag(spark, sf_dir)


def fresh_root(spark: SparkSession) -> str:
    """A new folder for each build: none is ever written twice."""
    return f"{checkpoint_root(spark)}/martlane-warehouse/{uuid.uuid4().hex}"


def register_star(spark: SparkSession, name: str, star: Star) -> None:
    """Make an already built warehouse answer the registry's queries under
    ``name`` (used when the star was built from real extracts)."""
    with _LOCK:
        _NAMED[(spark.sparkContext.applicationId, os.path.abspath(name))] = star


def star_for(spark: SparkSession, sf_dir: str, rebuild: bool = False, defects: bool = False, whole: bool = False) -> Star:
    """The warehouse built from the driver tables in ``sf_dir``, each table
    once per application and state of the input files; a changed file means a
    new build, and no build is shared between applications.  Tables are
    written when first asked for, all of them at once with ``whole`` and
    ``rebuild``.  ``defects``: loaded without cleaning from a defective
    extract (``driver.defective_orders``).
    """
    from martlane.plans.extract_store import extracts_once

    named = _NAMED.get((spark.sparkContext.applicationId, os.path.abspath(sf_dir)))
    if named is not None:
        return named
    key = (*input_key(spark, sf_dir), defects)
    with _LOCK:  # one build per (application, input), even with concurrent callers
        star = None if rebuild else _MEMO.get(key)
        if star is None:
            ex = extracts_once(spark, sf_dir)
            raw = defective_orders(ex.orders, ex.returns) if defects else clean_orders(ex.orders, ex.returns, ex.people)
            star = _MEMO[key] = GradualStar(fresh_root(spark), raw)
    return star.finish() if whole or rebuild else star
