"""Sinks and small source helpers."""

import datetime as dt

from pyspark.sql import functions as F

from lakemart.operators import hr
from lakemart.sources.files import normalise_column_case
from lakemart.sources.sinks import (NULL_PARTITION, append_load, publish, recover, replace_partitions, save_as_layer_table,
                                    table_exists, upsert_table, write_table)

D = dt.date


def test_layer_routing_and_full_refresh(spark):
    df = spark.createDataFrame([(1, "a")], "id long, v string")
    full = save_as_layer_table(spark, df, "gold", "t_route")
    assert full == "gold.t_route" and spark.table("gold.t_route").count() == 1
    save_as_layer_table(spark, df.limit(0), "gold", "t_route")  # full refresh with no rows
    assert spark.table("gold.t_route").count() == 0


def test_empty_full_refresh_keeps_a_typed_table(spark, scratch):
    write_table(spark.createDataFrame([], "id long, v string"), f"{scratch}/e")
    assert table_exists(spark, f"{scratch}/e")
    assert spark.read.parquet(f"{scratch}/e").schema.simpleString() == "struct<id:bigint,v:string>"


def test_upsert_table_unpartitioned_and_partitioned(spark, scratch):
    base = spark.createDataFrame([(1, D(2024, 1, 1), 10), (2, D(2024, 2, 1), 20)], "k long, m date, v long")
    upsert_table(spark, f"{scratch}/u", base, ["k"])
    upsert_table(spark, f"{scratch}/u", spark.createDataFrame([(2, D(2024, 2, 1), 21), (3, D(2024, 3, 1), 30)],
                                                             "k long, m date, v long"), ["k"])
    got = sorted(tuple(r) for r in spark.read.parquet(f"{scratch}/u").select("k", "v").collect())
    assert got == [(1, 10), (2, 21), (3, 30)]

    upsert_table(spark, f"{scratch}/p", base, ["k"], partition_col="m")
    upsert_table(spark, f"{scratch}/p", spark.createDataFrame([(2, D(2024, 2, 1), 22)], "k long, m date, v long"),
                 ["k"], partition_col="m")
    got = sorted(tuple(r) for r in spark.read.parquet(f"{scratch}/p").select("k", "v").collect())
    assert got == [(1, 10), (2, 22)]


def test_append_payroll_and_column_case(spark):
    old = spark.createDataFrame([(1, 100, D(2024, 1, 1))], "employee_id long, monthly_salary long, payroll_month date")
    new = spark.createDataFrame([(D(2024, 2, 1), 1, 110)], "payroll_month date, employee_id long, monthly_salary long")
    assert hr.append_payroll(old, new).count() == 2
    up = normalise_column_case(old, upper=True)
    assert up.columns == ["EMPLOYEE_ID", "MONTHLY_SALARY", "PAYROLL_MONTH"]
    assert normalise_column_case(up).columns == old.columns


def test_upsert_table_key_moving_between_partitions(spark, scratch):
    base = spark.createDataFrame([(1, D(2024, 1, 1), 10), (2, D(2024, 2, 1), 20)], "k long, m date, v long")
    upsert_table(spark, f"{scratch}/mv", base, ["k"], partition_col="m", keys_fixed_to_partition=False)
    moved = spark.createDataFrame([(1, D(2024, 3, 1), 11)], "k long, m date, v long")  # key 1 moves month
    upsert_table(spark, f"{scratch}/mv", moved, ["k"], partition_col="m", keys_fixed_to_partition=False)
    got = sorted((r.k, str(r.m), r.v) for r in spark.read.parquet(f"{scratch}/mv").collect())
    assert got == [(1, "2024-03-01", 11), (2, "2024-02-01", 20)]


def _stored(spark, path):
    return sorted(((r.k, r.m and str(r.m), r.v) for r in spark.read.parquet(path).collect()), key=str)


def test_upsert_keeps_rows_of_the_null_partition(spark, scratch):
    schema = "k long, m date, v long"
    for fixed in (True, False):
        path = f"{scratch}/n{fixed}"
        upsert_table(spark, path, spark.createDataFrame([(1, None, 10), (2, None, 20), (3, D(2024, 1, 1), 30)], schema), ["k"], "m",
                     keys_fixed_to_partition=fixed)
        upsert_table(spark, path, spark.createDataFrame([(4, None, 40)], schema), ["k"], "m", keys_fixed_to_partition=fixed)
        assert _stored(spark, path) == [(1, None, 10), (2, None, 20), (3, "2024-01-01", 30), (4, None, 40)]


def test_keys_move_from_and_to_the_null_partition(spark, scratch):
    schema, path = "k long, m date, v long", f"{scratch}/mv"
    upsert_table(spark, path, spark.createDataFrame([(1, None, 10), (2, D(2024, 2, 1), 20)], schema), ["k"], "m",
                 keys_fixed_to_partition=False)
    upsert_table(spark, path, spark.createDataFrame([(1, D(2024, 3, 1), 11), (2, None, 21)], schema), ["k"], "m",
                 keys_fixed_to_partition=False)
    assert _stored(spark, path) == [(1, "2024-03-01", 11), (2, None, 21)]
    upsert_table(spark, path, spark.createDataFrame([(2, D(2024, 3, 1), 22)], schema), ["k"], "m", keys_fixed_to_partition=False)
    assert _stored(spark, path) == [(1, "2024-03-01", 11), (2, "2024-03-01", 22)]
    import os
    assert f"m={NULL_PARTITION}" not in os.listdir(path)


def test_replace_partitions_removes_what_is_empty_now(spark, scratch):
    schema, path = "k long, m date, v long", f"{scratch}/r"
    write_table(spark.createDataFrame([(1, D(2024, 1, 1), 1), (2, D(2024, 2, 1), 2), (3, None, 3)], schema), path, partition_by=["m"])
    replace_partitions(spark.read.parquet(path).filter("k = 2").selectExpr("k", "m", "v + 1 AS v"), path, "m",
                       [D(2024, 1, 1), D(2024, 2, 1), None])
    assert _stored(spark, path) == [(2, "2024-02-01", 3)]


def test_a_half_done_swap_is_completed(spark, scratch):
    import json
    import os

    schema, path, staging = "k long, m date, v long", f"{scratch}/t", f"{scratch}/_staged-x"
    write_table(spark.createDataFrame([(1, D(2024, 1, 1), 1), (2, D(2024, 2, 1), 2), (3, D(2024, 3, 1), 3)], schema), path, partition_by=["m"])
    write_table(spark.createDataFrame([(1, D(2024, 1, 1), 10), (2, D(2024, 2, 1), 20)], schema), staging, partition_by=["m"])
    with open(f"{scratch}/_swap-t.json", "w") as f:
        json.dump({"staging": staging, "parts": ["m=2024-01-01", "m=2024-02-01"], "emptied": ["m=2024-03-01"]}, f)
    os.rename(f"{path}/m=2024-01-01", f"{scratch}/gone")  # the driver was lost between the two steps of a move
    assert table_exists(spark, path)
    assert _stored(spark, path) == [(1, "2024-01-01", 10), (2, "2024-02-01", 20)]
    recover(spark, path)
    assert sorted(os.listdir(scratch)) == ["gone", "t"]


def test_append_load_takes_late_tied_and_untimed_rows_once(spark, scratch):
    schema, path = "id long, ts timestamp_ntz", f"{scratch}/a"
    t = dt.datetime
    first = spark.createDataFrame([(1, t(2024, 1, 2)), (2, None)], schema)
    more = spark.createDataFrame([(1, t(2024, 1, 2)), (2, None), (3, t(2024, 1, 1)), (4, t(2024, 1, 2)), (5, None), (6, t(2024, 1, 3))], schema)
    for rows in (first, more, more):
        append_load(rows, path, ["id"], "ts")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2, 3, 4, 5, 6]


def test_publish_makes_a_catalog_table_of_stored_files(spark, scratch):
    path = f"{scratch}/pub"
    write_table(spark.createDataFrame([(1, D(2024, 1, 1)), (2, None)], "k long, m date"), path, partition_by=["m"])
    assert publish(spark, path, "gold", "t_pub") == "gold.t_pub" and spark.table("gold.t_pub").count() == 2


def test_files_of_a_partitioned_write_do_not_grow_with_the_tasks(spark, scratch):
    """Every task once opened a file in every partition, and each listing sent them all to the driver."""
    path = f"{scratch}/t"
    rows = spark.range(0, 400, 1, 8).select(F.col("id").alias("k"), F.when(F.col("id") % 4 > 0, F.date_add(F.lit(D(2024, 1, 1)), (F.col("id") % 4).cast("int"))).alias("m"))
    write_table(rows, path, partition_by=["m"])
    assert len(spark.read.parquet(path).inputFiles()) == 4
    more = rows.withColumn("k", F.col("k") + 1)
    replace_partitions(more.filter("m is null or m = '2024-01-02'"), path, "m", [None, D(2024, 1, 2)])
    assert len(spark.read.parquet(path).inputFiles()) == 4
    want = more.filter("m is null or m = '2024-01-02'").union(rows.filter("m > '2024-01-02'"))
    assert sorted(spark.read.parquet(path).select("k", "m").collect(), key=str) == sorted(want.collect(), key=str)
