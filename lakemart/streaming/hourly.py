"""Structured Streaming versions of the delta loads.

* ``hourly_mart_stream`` — the exact hourly traffic mart (two distinct
  counts and a row count per hour). Exact distinct counts are not
  supported as streaming aggregates, so each micro-batch (``foreachBatch``):
  1. appends its rows to a silver table partitioned by event day, under a
     ``batch_id`` sub-partition that is overwritten on retry (idempotent);
  2. recomputes the mart for the event days the batch touched, from silver;
  3. replaces exactly those day partitions of the mart.
  Late rows simply re-open their day; nothing is dropped.
* ``hourly_visits_dropping_late`` — the watermark form for one distinct
  count: ``dropDuplicates`` on (hour, visitor) within the watermark, then a
  tumbling 1-hour window count in append mode. Rows later than the delay are
  dropped; use the exact form where they count.
* ``fact_upsert_stream`` — each micro-batch of orders becomes fact rows
  upserted by ``order_id`` into month partitions; a batch rewrites only the
  months that it touches.
* ``quarantine_late_rows`` — rows that a watermark load would lose go to a
  side table, once for each batch.

Checkpoint locations must be on shared storage; callers pass them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakemart.functions.exprs import trunc_ts
from lakemart.operators import gold, silver
from lakemart.operators.incremental import high_watermark_delta, late_rows
from lakemart.sources.sinks import distinct_values, one_of, replace_partitions, table_exists, upsert_table, write_table


# What the streams store: a batch without rows leaves no file to read a schema from.
_SILVER = ("traffic_id string, event_timestamp timestamp_ntz, item_in_cart string, product_id long, order_id long, "
           "event_day date, batch_id long")
_MART = ("event_hour timestamp_ntz, event_date date, hour_of_day int, total_visits long, total_carts long, total_orders long, "
         "event_day date")


def _batch_to_silver(batch: DataFrame, batch_id: int, silver_path: str) -> None:
    rows = silver.stg_traffic(batch).withColumn("event_day", F.col("event_timestamp").cast("date")) \
        .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    # Overwrite only (event_day, batch_id) partitions of this batch: a retried
    # batch replaces its own earlier attempt instead of duplicating it.
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("event_day", "batch_id").parquet(silver_path))


def hourly_mart_foreach_batch(silver_path: str, mart_path: str):
    """The ``foreachBatch`` function of the exact streaming hourly mart."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _batch_to_silver(batch, batch_id, silver_path)
        # The batch is read once; its days are partition names of what it has written.
        stored = spark.read.schema(_SILVER).parquet(silver_path)
        days = distinct_values(stored.filter(F.col("batch_id") == batch_id), "event_day")
        mart = gold.mart_hourly_traffic_conversion(stored.filter(one_of("event_day", days)).drop("event_day", "batch_id"))
        mart = mart.withColumn("event_day", F.col("event_date"))
        if table_exists(spark, mart_path):
            replace_partitions(mart, mart_path, "event_day", days)
        else:
            write_table(mart, mart_path, "overwrite", ["event_day"])

    return run


def hourly_mart_stream(spark: SparkSession, source: DataFrame, silver_path: str, mart_path: str,
                       checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Start the exact hourly mart stream over a streaming raw-traffic DataFrame."""
    w = source.writeStream.foreachBatch(hourly_mart_foreach_batch(silver_path, mart_path)) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_hourly_mart(spark: SparkSession, mart_path: str) -> DataFrame:
    return spark.read.schema(_MART).parquet(mart_path).select(
        "event_hour", "event_date", "hour_of_day", "total_visits", "total_carts", "total_orders")


def hourly_visits_dropping_late(stream: DataFrame, ts_col: str = "event_time", delay: str = "2 hours") -> DataFrame:
    """Distinct visitors per tumbling hour with bounded state (append mode).

    Event-time columns must be ``timestamp`` (not ``timestamp_ntz``) for a
    watermark, so the column is converted first.
    """
    s = stream.withColumn("_ts", F.col(ts_col).cast("timestamp")).withWatermark("_ts", delay)
    s = s.withColumn("_hour", F.date_trunc("hour", "_ts")).dropDuplicatesWithinWatermark(["_hour", "traffic_id"])
    return (s.groupBy(F.window("_ts", "1 hour").alias("w"))
            .agg(F.count(F.lit(1)).alias("total_visits"))
            .select(trunc_ts("hour", F.col("w.start")).alias("event_hour"), "total_visits"))


def fact_upsert_foreach_batch(fact_path: str, products: DataFrame, prepare=None):
    """``prepare`` turns a batch into raw orders where the stream holds something else."""
    def run(batch: DataFrame, batch_id: int) -> None:
        fact = gold.fact_orders_gold(silver.stg_orders(prepare(batch) if prepare else batch), products)
        upsert_table(batch.sparkSession, fact_path, fact.withColumn("order_month", F.trunc("order_date", "MM")), ["order_id"],
                     "order_month", ["order_timestamp"], keys_fixed_to_partition=False)
    return run


def fact_upsert_stream(source: DataFrame, fact_path: str, products: DataFrame, checkpoint: str,
                       available_now: bool = True, prepare=None) -> StreamingQuery:
    w = source.writeStream.foreachBatch(fact_upsert_foreach_batch(fact_path, products, prepare)) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def quarantine_late_rows(spark: SparkSession, batch: DataFrame, target_path: str, ts_col: str, keys: list[str],
                         quarantine_path: str, batch_id: int = 0, target_col: str | None = None) -> DataFrame:
    """Split a batch: rows above the stored watermark are returned for loading; rows that are not, and
    that the target does not hold, are written to ``quarantine_path`` under the batch's id, so a
    repeated batch replaces its own rows."""
    if not table_exists(spark, target_path):
        return batch
    target = spark.read.parquet(target_path)
    (late_rows(batch, target, ts_col, keys, target_col).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(quarantine_path))
    return high_watermark_delta(batch, target, ts_col, target_col)
