"""Sinks (S6, S13-S16): CSV / Parquet writers, mart export, catalog tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from martlane.operators.marts import MART_GRAINS, MARTS, rolled_up
from martlane.session import checkpoint_root
from martlane.sources.catalog import create_table, remove, replace_table


#: Rows of a compressed CSV file, which one task reads.
COMPRESSED_ROWS = 1_000_000


def write_csv(df: DataFrame, path: str, single_file: bool = False, compression: str | None = None) -> None:
    """CSV (RFC 4180: quotes doubled) with a header row, no index,
    overwrite.  ``single_file`` only for outputs whose size is bounded
    (coalesce(1) funnels into one task).  ``compression``: a codec such as
    'gzip', for files that nothing but Spark reads; they cannot be split, so
    none has more than ``COMPRESSED_ROWS`` rows."""
    out = df.coalesce(1) if single_file else df
    w = out.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
    if compression:
        w = w.option("compression", compression).option("maxRecordsPerFile", COMPRESSED_ROWS)
    w.csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: str | list[str] | None = None) -> None:
    """Parquet, overwrite, optionally partitioned (e.g. by order year)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)


def write_by_year(df: DataFrame, path: str, date: str = "order_date", only_years: bool = False) -> None:
    """Parquet in a folder for each ``order_year`` of ``date`` (undated
    rows have their own).  Rows are gathered by year and large years dealt to
    several tasks by measured size (AQE rebalancing), so files are bounded by
    the advisory partition size, not by tasks x years.  ``only_years``
    rewrites the folders of the years in ``df`` and leaves the others."""
    out = df.withColumn("order_year", F.year(date)).hint("rebalance", "order_year")
    mode = "dynamic" if only_years else "static"
    out.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("order_year").parquet(path)


def write_one_csv(df: DataFrame, path: str) -> None:
    """One CSV file named ``path``, for results of bounded size.  It is
    written beside its place and renamed over a file that is there, so readers
    see the old file or the new one."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    target, beside = hadoop.Path(path), hadoop.Path(f"{path}.{uuid.uuid4().hex}.writing")
    fs = target.getFileSystem(conf)
    try:
        write_csv(df, beside.toString(), single_file=True)
        part = fs.globStatus(hadoop.Path(beside, "part-*"))[0].getPath()
        if fs.exists(target) and fs.getFileStatus(target).isDirectory():
            fs.delete(target, True)  # what older versions wrote
        over = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
        over[0] = hadoop.Options.Rename.OVERWRITE
        context = hadoop.FileContext.getFileContext(fs.getUri(), conf)
        context.rename(fs.makeQualified(part), fs.makeQualified(target), over)
    finally:
        fs.delete(beside, True)


def save_table(df: DataFrame, name: str, replace: bool = True) -> None:
    """S6 / CTAS: CREATE OR REPLACE (``replace``) or CREATE IF NOT EXISTS.  A
    replacement that fails leaves the old table (``sources.catalog``)."""
    (replace_table if replace else create_table)(df, name)


def export_mart(df: DataFrame, path: str, bounded: bool = False, fmt: str = "csv") -> int:
    """Write a mart (CSV with header, or Parquet) and return its row count.
    A bounded mart becomes one CSV file of that name.

    The count is an observed metric of the write itself (no second pass)."""
    obs = Observation("export")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if fmt == "csv":
        (write_one_csv if bounded else write_csv)(observed, path)
    elif fmt == "parquet":
        write_parquet(observed.coalesce(1) if bounded else observed, path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return int(obs.get["rows"])


def export_all(star, out_dir: str, fmt: str = "csv") -> dict[str, int]:
    """Publish the six marts in the reference's order -> {file: rows}.

    The fact is read twice: once for the roll-ups that five marts start from
    (by order, by product), written to the shared folder and removed at the
    end, and once for the mart by discount, which would gain nothing from one.
    Nothing is cached (a lost executor would drop cached blocks)."""
    spark = star.fact_sales.sparkSession
    beside = f"{checkpoint_root(spark)}/martlane-rollups/{uuid.uuid4().hex}"
    out: dict[str, int] = {}
    try:
        stars = rolled_up(star, beside)
        for mart, (file_name, build, bounded) in MARTS.items():
            name = file_name if fmt == "csv" else file_name.replace(".csv", ".parquet")
            df = build(stars.get(MART_GRAINS.get(mart), star))
            out[name] = export_mart(df, f"{out_dir.rstrip('/')}/{name}", bounded, fmt)
    finally:
        remove(spark, beside)
    return out
