"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.session import apply_defaults, checkpoint_dir, materialize

__all__ = ["bounded_batches", "checkpoint_dir", "crc_bucket", "filesystem", "let", "materialize", "read", "small", "stored",
           "text_key", "tokenizer_path", "workspace"]

#: Rows of some numbers each that may be broadcast; a larger table is shuffled.
BROADCAST_ROWS = 500_000

#: Rows of an Arrow batch sent to Python. Texts may be very long, so a batch is kept
#: well below Spark's default of 10,000 rows.
BATCH_ROWS = 400


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver imported it from: Spark
    hands a zip of it to the executors, once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="lakemart-py-"), "lakemart.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def bounded_batches(spark: SparkSession) -> None:
    """Session settings of every operator here that sends texts to Python."""
    apply_defaults(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder once and read it from there: later steps
    neither recompute it nor depend on the executors that made it."""
    path = workspace(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame) -> DataFrame:
    """A stored table of a few numbers a row, marked for broadcast if it is small enough to be."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """Arrow file system and path for a folder that tasks write raw files to or read them from."""
    if "://" in uri or uri.startswith("file:"):
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), os.path.abspath(uri)


def crc_bucket(col, n: int):
    """crc32 of an id's decimal text, modulo ``n``: the fold of a row."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % n


def text_key(col: str) -> list[Column]:
    """t1, t2: two numbers that stand for a text in joins; null and empty are one text."""
    text = F.coalesce(F.col(col), F.lit(""))
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("text"), text).alias("t2")]


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once. An expression that a lambda uses is
    otherwise computed again for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def tokenizer_path(name: str) -> str:
    """Where the installed public vocabulary ``name`` lies; never copied into this repository."""
    import public_tokenizers
    return public_tokenizers.path(name)
