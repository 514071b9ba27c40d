"""Catalog tables (S6, S18): create or replace, create if not exists, and a
written warehouse as tables that a SQL user can query.

A replacement is first written to a folder of its own below the database's
location; only then is the table pointed to it.  A write that fails leaves the
table as it was.  The version before the last one is removed, so readers that
planned on the last one still finish.  Whether a table exists is asked from
the session catalog.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Table property that holds where the version before the present one lies.
PREVIOUS = "martlane.previous"


def qualified(spark: SparkSession, name: str) -> tuple[str, str]:
    """(database, table); a bare name belongs to the current database."""
    database, _, table = name.rpartition(".")
    return database or spark.catalog.currentDatabase(), table


def _sql_name(database: str, table: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in (database, table))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _details(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return {r.col_name: r.data_type for r in rows}


def _previous(spark: SparkSession, name: str) -> str | None:
    found = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return found.get(PREVIOUS)


def _layout(spark: SparkSession, name: str) -> list[tuple[str, str, bool]]:
    return [(c.name, c.dataType, c.isPartition) for c in spark.catalog.listColumns(name)]


def _create(spark: SparkSession, name: str, path: str) -> None:
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION {_text(path)}")
    if any(partition for *_, partition in _layout(spark, name)):
        spark.sql(f"MSCK REPAIR TABLE {name}")


def point_to(spark: SparkSession, name: str, path: str) -> None:
    """Make table ``name`` the Parquet files of ``path``: created where it is
    absent, else moved to the new place.  Equal columns move in one catalog
    change; other columns or partitions need a rename of the old and the new
    table, between which the name is absent for a moment."""
    database, table = qualified(spark, name)
    target, fresh, old = (_sql_name(database, t) for t in (table, f"{table}__new", f"{table}__old"))
    for leftover in (fresh, old):
        spark.sql(f"DROP TABLE IF EXISTS {leftover}")
    if not spark.catalog.tableExists(target):
        _create(spark, target, path)
        return
    before, expired = _details(spark, target)["Location"], _previous(spark, target)
    _create(spark, fresh, path)
    columns = _layout(spark, fresh)
    if columns == _layout(spark, target) and not any(partition for *_, partition in columns):
        spark.sql(f"ALTER TABLE {target} SET LOCATION {_text(path)}")
        spark.sql(f"DROP TABLE {fresh}")
    else:
        spark.sql(f"ALTER TABLE {target} RENAME TO {old}")
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {target}")
        spark.sql(f"DROP TABLE {old}")
    spark.sql(f"ALTER TABLE {target} SET TBLPROPERTIES ({_text(PREVIOUS)} = {_text(before)})")
    spark.catalog.refreshTable(target)
    if expired and f"{_home(spark, database, table)}/" in expired and expired not in (before, path):
        remove(spark, expired)


def _home(spark: SparkSession, database: str, table: str) -> str:
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{table}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def replace_table(df: DataFrame, name: str, partition_by: str | list[str] | None = None) -> DataFrame:
    """CREATE OR REPLACE TABLE ``name`` AS ``df``, which may read the table it
    replaces; returns the table."""
    spark = df.sparkSession
    database, table = qualified(spark, name)
    path = f"{_home(spark, database, table)}/{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    try:
        writer.parquet(path)
    except Exception:
        remove(spark, path)
        raise
    point_to(spark, name, path)
    return spark.table(_sql_name(database, table))


def create_table(df: DataFrame, name: str) -> DataFrame:
    """CREATE TABLE IF NOT EXISTS ``name`` AS ``df``: a table that is there
    stays as it is and ``df`` is not run."""
    found = table_or_none(df.sparkSession, name)
    return replace_table(df, name) if found is None else found


def table_or_none(spark: SparkSession, name: str) -> DataFrame | None:
    """The table, or None where the catalog has none of that name."""
    full = _sql_name(*qualified(spark, name))
    return spark.table(full) if spark.catalog.tableExists(full) else None


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")
