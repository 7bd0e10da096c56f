"""Sinks: full refresh, append, CSV, JDBC, catalog tables and the key upsert.

A write never goes to files that its own plan still reads: new partitions are
staged beside the table and swapped in when they are complete. A small
journal names the swap, so that a driver lost between two moves leaves a
table that the next access completes (``recover``). Only the partitions the
delta touches are read (partition pruning) and replaced, so an incremental
run costs in proportion to the delta, not to the table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators.incremental import latest_per_key, unstored_rows
from lakemart.session import materialize, shuffled

# Fixed value: the folder name Spark gives to a NULL partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def table_exists(spark: SparkSession, path: str) -> bool:
    recover(spark, path)
    try:
        spark.read.parquet(path).schema  # noqa: B018
        return True
    except AnalysisException:
        return False


def by_partition(df: DataFrame, column: str) -> DataFrame:
    """``df`` with the rows of a partition value together, so that a partitioned write leaves files by
    the bytes of each partition. Without it every task opens a file in every partition, and writes and
    the listings of the table, whose results go to the driver, grow with tasks x partitions. Large
    partitions are split over several tasks by AQE."""
    return df.hint("rebalance", column)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
                fmt: str = "parquet", dynamic: bool = False) -> None:
    """Full refresh (``overwrite``) or ``append``. An empty frame still leaves a
    typed, empty table behind (a full refresh never deletes the table).
    ``dynamic`` overwrites only the partitions present in ``df``."""
    w = (by_partition(df, partition_by[0]) if partition_by else df).write.mode(mode).format(fmt)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_csv(df: DataFrame, path: str, mode: str = "append",
              timestamp_format: str = "yyyy-MM-dd HH:mm:ss") -> None:
    """CSV landing write with a header in every part file."""
    (df.write.mode(mode).option("header", True).option("timestampNTZFormat", timestamp_format)
     .option("timestampFormat", timestamp_format).csv(path))


def save_as_layer_table(spark: SparkSession, df: DataFrame, layer: str, name: str,
                        mode: str = "overwrite", partition_by: list[str] | None = None) -> str:
    """Catalog table ``<layer>.<name>`` (databases ``raw``, ``silver``, ``gold``)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    w = df.write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    full = f"{layer}.{name}"
    w.saveAsTable(full)
    return full


def publish(spark: SparkSession, path: str, layer: str, name: str) -> str:
    """Catalog table ``<layer>.<name>`` over files that are already stored."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    full = f"{layer}.{name}"
    spark.sql(f"DROP TABLE IF EXISTS {full}")
    spark.catalog.createTable(full, path=path, source="parquet")
    if any(c.isPartition for c in spark.catalog.listColumns(full)):
        spark.catalog.recoverPartitions(full)
    return full


def append_load(source: DataFrame, path: str, keys: list[str], ts_col: str) -> None:
    """Append to the raw table at ``path`` the rows whose keys it does not hold yet, whenever
    they arrive. Newer versions of stored keys are appended too: a raw table keeps history."""
    spark = source.sparkSession
    if not table_exists(spark, path):
        write_table(source, path, "append")
        return
    stored = spark.read.parquet(path)
    write_table(unstored_rows(source, stored, keys, ts_col), path, "append")


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", properties: dict | None = None,
               batch_size: int = 10000, num_partitions: int | None = None) -> None:
    """Batched multi-row inserts; ``num_partitions`` caps concurrent connections."""
    if num_partitions:
        df = df.repartition(num_partitions)
    w = df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table) \
        .option("batchsize", str(batch_size))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


class Files:
    """Moves and deletes on the table's own file system (any that Spark reads)."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self.path = jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.path(path))

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)

    def move(self, source: str, target: str) -> None:
        if not self.fs.rename(self.path(source), self.path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def children(self, path: str) -> list[str]:
        return [f.getPath().getName() for f in self.fs.listStatus(self.path(path))] if self.exists(path) else []

    def write(self, path: str, text: str) -> None:
        """Beside, then renamed: a reader sees the whole file or none."""
        beside = f"{path}.{uuid.uuid4().hex}.tmp"
        out = self.fs.create(self.path(beside), True)
        out.write(text.encode())
        out.close()
        self.move(beside, path)

    def read(self, path: str) -> str:
        stream = self.fs.open(self.path(path))
        text = bytes(stream.readAllBytes()).decode()
        stream.close()
        return text


def _journal(path: str) -> str:
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/_swap-{name}.json"


def recover(spark: SparkSession, path: str) -> None:
    """Complete a swap that a lost driver left half done. Every move is repeatable: a staged
    folder that is gone has been moved already."""
    files = Files(spark, path)
    if not files.exists(_journal(path)):
        return
    plan = json.loads(files.read(_journal(path)))
    for name in plan["parts"]:
        staged, target = f"{plan['staging']}/{name}".rstrip("/"), f"{path.rstrip('/')}/{name}".rstrip("/")
        if files.exists(staged):
            files.delete(target)
            files.move(staged, target)
    for name in plan["emptied"]:
        files.delete(f"{path.rstrip('/')}/{name}")
    files.delete(plan["staging"])
    files.delete(_journal(path))


def _swap(spark: SparkSession, path: str, staging: str, parts: list[str], emptied: list[str]) -> None:
    Files(spark, path).write(_journal(path), json.dumps({"staging": staging, "parts": parts, "emptied": emptied}))
    recover(spark, path)
    spark.catalog.refreshByPath(path)


def one_of(column: str, values: list) -> Column:
    """``column`` is one of the values, which may hold NULL. Literals, so a partitioned scan is
    pruned before it starts."""
    given = [v for v in values if v is not None]
    found = F.col(column).isin(*given) if given else F.lit(False)
    return found | F.col(column).isNull() if None in values else found


def replace_partitions(df: DataFrame, path: str, column: str, values: list) -> None:
    """Make ``df`` the whole content of the partitions ``column`` = ``values`` (NULL among them
    allowed); a value without rows loses its partition. ``values`` is bounded by the calendar.

    The rows are written beside the table first, so ``df`` may read the table itself.
    """
    spark = df.sparkSession
    recover(spark, path)
    files = Files(spark, path)
    staging = f"{path.rstrip('/').rpartition('/')[0]}/_staged-{uuid.uuid4().hex}"
    by_partition(df, column).write.partitionBy(column).parquet(staging)
    wanted = {NULL_PARTITION if v is None else str(v) for v in values}
    value_of = {n: unquote(n.partition("=")[2]) for n in {*files.children(path), *files.children(staging)} if n.startswith(f"{column}=")}
    parts = [n for n in files.children(staging) if n in value_of]
    emptied = [n for n in files.children(path) if n in value_of and value_of[n] in wanted and n not in parts]
    _swap(spark, path, staging, parts, emptied)


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Make ``df`` the whole table: staged beside it and swapped in, so that a reader and a run
    that breaks off find the old table or the new one, and ``df`` may read the table itself."""
    recover(df.sparkSession, path)
    staging = f"{path.rstrip('/').rpartition('/')[0]}/_staged-{uuid.uuid4().hex}"
    write_table(df, staging, "errorifexists", partition_by)
    _swap(df.sparkSession, path, staging, [""], [])


def distinct_values(df: DataFrame, column: str) -> list:
    """Values of a period column, NULL included; one per calendar period, so they fit the driver."""
    return [r[0] for r in df.select(column).distinct().collect()]


def upsert_table(spark: SparkSession, path: str, delta: DataFrame, keys: list[str],
                 partition_col: str | None = None, order_cols: list[str] | None = None,
                 keys_fixed_to_partition: bool = True, dedupe: bool = True, replaced: DataFrame | None = None,
                 before_swap: Callable[[list | None], None] | None = None) -> list:
    """MERGE ``delta`` into the parquet table at ``path`` by ``keys`` (NULL-safe).

    * first run (no table): the de-duplicated delta is written;
    * partitioned table: the partitions named in the delta, NULL among them, are read
      (pruned scan), merged with the delta and swapped in; others are not rewritten;
    * unpartitioned table: the whole table is merged and swapped.

    ``keys_fixed_to_partition=False`` is for keys that may move between
    partitions (an order re-delivered with a timestamp in another month, or
    at last with one): the partitions still holding an older version of a
    delta key are found with a semi join over the key and partition columns
    only, and are merged and rewritten too. ``dedupe=False`` is for deltas
    that have one row per key already (aggregates). ``replaced`` names keys
    whose stored rows go even where the delta has none for them (deletions).
    ``before_swap`` is told the touched partition values (None: all) before
    the table changes. Returns them.
    """
    delta = latest_per_key(delta, keys, order_cols) if dedupe else delta
    tell = before_swap or (lambda touched: None)
    if not table_exists(spark, path):
        tell(None)
        replace_table(delta, path, [partition_col] if partition_col else None)
        return distinct_values(spark.read.parquet(path), partition_col) if partition_col and table_exists(spark, path) else []
    # The delta is computed once and kept in the checkpoint folder (its size
    # is the delta's, not the table's); an empty delta ends the step.
    delta = materialize(delta)
    gone = delta.select(*keys)
    if replaced is not None:
        gone = materialize(gone.unionByName(replaced.select(*keys)).distinct())
    if gone.isEmpty():
        return []
    touched = distinct_values(delta, partition_col) if partition_col else []
    target = spark.read.parquet(path)
    if not partition_col:
        tell(None)
        replace_table(_merged(target, delta, gone, keys), path)
        return []
    if not keys_fixed_to_partition:
        dk = shuffled(gone.select(*[F.col(k).alias(f"_k_{k}") for k in keys]))
        probe = target.select(*keys, partition_col)
        if len(keys) == 1:
            # The delta's key range reaches the parquet reader: row groups whose
            # key statistics lie outside it are skipped.
            lo, hi = gone.agg(F.min(keys[0]), F.max(keys[0])).first()
            k = F.col(keys[0])
            probe = probe.filter(k.isNull() if lo is None else k.between(lo, hi) | k.isNull())
        cond = [probe[k].eqNullSafe(dk[f"_k_{k}"]) for k in keys]
        held = distinct_values(probe.join(dk, cond, "left_semi"), partition_col)
        touched += [v for v in held if v not in touched]
    if not touched:
        return []
    tell(touched)
    target = target.filter(one_of(partition_col, touched))
    replace_partitions(_merged(target, delta, gone, keys), path, partition_col, touched)
    return touched


def _merged(target: DataFrame, delta: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` without the keys of ``gone``, and the delta."""
    named = shuffled(gone.select(*[F.col(k).alias(f"_k_{k}") for k in keys]))
    kept = target.join(named, [target[k].eqNullSafe(named[f"_k_{k}"]) for k in keys], "left_anti")
    return kept.unionByName(delta.select(*target.columns))
