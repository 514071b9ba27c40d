"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlane.session import checkpoint_root

#: Words of every contract: runs of anything but the six ASCII white-space
#: characters (what ``bytes.split()`` without arguments splits on).
SPACE_CLASS = r"\x20\x09-\x0D"

#: Rows that a Python task works on at a time; results do not depend on it.
CHUNK_ROWS = 512


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from the folder the driver has
    it in, whatever folder the driver was started from."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    have = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in have:
        env["PYTHONPATH"] = os.pathsep.join([root, *have])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared checkpoint folder and
    read it back: lineage ends there, so a lost executor costs a re-read."""
    path = f"{checkpoint_root(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Written tables that are only needed until a later one is written."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def written(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{checkpoint_root(self.spark)}/llm-{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Remove the tables; call it when nothing lazy reads them any more."""
        context = self.spark.sparkContext
        for path in self.paths:
            p = context._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(context._jsc.hadoopConfiguration()).delete(p, True)
        self.paths = []


def appended(schema: T.StructType, new: list[T.StructField]) -> T.StructType:
    """``schema`` followed by ``new``; a new column replaces an input column
    of the same name (names compared as Spark does, without case)."""
    names = {f.name.lower() for f in new}
    return T.StructType([f for f in schema.fields if f.name.lower() not in names] + list(new))


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that ``df`` has no column of."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def without(batch: pa.RecordBatch, names: Iterable[str]) -> tuple[list, list]:
    """Arrays and names of ``batch`` except ``names`` (case-insensitive)."""
    drop = {n.lower() for n in names}
    keep = [i for i, n in enumerate(batch.schema.names) if n.lower() not in drop]
    return [batch.column(i) for i in keep], [batch.schema.names[i] for i in keep]


def chunks(batches: Iterable[pa.RecordBatch], rows: int = CHUNK_ROWS) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def texts_of(column: pa.Array) -> list[str]:
    """Python strings of a text column, null as the empty text."""
    return [t or "" for t in column.to_pylist()]


def crc_mod(col: str, n: int):
    """crc32 of the id written as text, modulo ``n`` (null for a null id)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(n)
