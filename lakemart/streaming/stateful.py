"""The hourly traffic mart as an arbitrary stateful stream with event-time timers.

An hour is a key. While it is open, its state holds the visitors and orders seen so far (each
batch adds its distinct ones) and a count; a timer closes it when the watermark reaches its
end: the exact distinct counts are emitted once and the state is dropped, so the state is
bounded by the hours that the watermark still allows. A row of an hour that is closed already
is not lost and does not reopen it: it leaves by the side output, tagged, with all its
columns. The query's checkpoint holds state, timers and watermark, so a restarted query goes
on where the last one ended, and each batch is written under its id, so a repeated batch
replaces its own rows.

State needs the RocksDB provider; the callers' setting is put back after the start.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from lakemart.functions.exprs import trunc_ts

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HOUR_MS = 3_600_000
OUT = ("late boolean, hour_ms long, total_visits long, total_carts long, total_orders long, at_us long, traffic_id string, "
       "item_in_cart string, product_id long, order_id long")
_COLUMNS = [c.split()[0] for c in OUT.split(", ")]
_STORED = OUT.partition(", ")[2] + ", batch_id long"


def _out(rows: pd.DataFrame) -> pd.DataFrame:
    """All columns of the output as plain objects, None where there is nothing."""
    rows = rows.reindex(columns=_COLUMNS).astype(object)
    return rows.where(rows.notna(), None)


class HourProcessor(StatefulProcessor):
    """Distinct visitors, rows in the cart and distinct orders of one hour."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.visitors = handle.getListState("visitors", "traffic_id string")
        self.orders = handle.getListState("orders", "order_id long")
        self.carts = handle.getValueState("carts", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        hour = int(key[0])
        if hour + HOUR_MS <= timerValues.getCurrentWatermarkInMs():
            for part in rows:
                yield _out(part.assign(late=True))
            return
        visitors, orders, carts = set(), set(), 0
        for part in rows:
            visitors.update(part["traffic_id"].dropna())
            orders.update(part["order_id"].dropna().astype("int64"))
            carts += int((part["item_in_cart"] == "yes").sum())
        before = self.carts.get() if self.carts.exists() else None
        if before is None:
            self.handle.registerTimer(hour + HOUR_MS)
        self.carts.update((carts + (before[0] if before else 0),))
        if visitors:
            self.visitors.appendList([(v,) for v in sorted(visitors)])
        if orders:
            self.orders.appendList([(int(o),) for o in sorted(orders)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        visits = len({v[0] for v in self.visitors.get()}) if self.visitors.exists() else 0
        orders = len({o[0] for o in self.orders.get()}) if self.orders.exists() else 0
        carts = self.carts.get()[0]
        for state in (self.visitors, self.orders, self.carts):
            state.clear()
        yield _out(pd.DataFrame({"late": [False], "hour_ms": [int(key[0])], "total_visits": [visits], "total_carts": [carts],
                                 "total_orders": [orders]}))

    def close(self) -> None:
        pass


def hourly_states(traffic: DataFrame, delay: str) -> DataFrame:
    """The tagged output over a stream of raw traffic: closed hours, and late rows."""
    timed = (traffic.select(F.col("event_time").cast("timestamp").alias("_ts"), "traffic_id", "item_in_cart", "product_id", "order_id")
             .filter("_ts IS NOT NULL").withWatermark("_ts", delay))
    # The time goes on as a plain number: the operator itself decides what is late.
    rows = timed.select(F.unix_millis(F.date_trunc("hour", "_ts")).alias("hour_ms"), F.unix_micros("_ts").alias("at_us"), "traffic_id",
                        "item_in_cart", "product_id", "order_id")
    return rows.groupBy("hour_ms").transformWithStateInPandas(
        statefulProcessor=HourProcessor(), outputStructType=OUT, outputMode="Append", timeMode="EventTime")


@contextlib.contextmanager
def _rocksdb(spark: SparkSession):
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


def stateful_hourly_stream(spark: SparkSession, traffic: DataFrame, hours_path: str, late_path: str, checkpoint: str,
                           delay: str = "2 hours", available_now: bool = True) -> StreamingQuery:
    """Start the stream: closed hours are appended to ``hours_path``, late rows to ``late_path``."""
    def store(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).persist()
        for late, path in ((False, hours_path), (True, late_path)):
            (batch.filter(F.col("late") == late).drop("late").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(path))
        batch.unpersist()

    with _rocksdb(spark):
        w = hourly_states(traffic, delay).writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).outputMode("append")
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
        return w.start()


def _hour() -> Column:
    return trunc_ts("hour", F.timestamp_millis("hour_ms").cast("timestamp_ntz"))


def read_hours(spark: SparkSession, hours_path: str) -> DataFrame:
    hour = _hour()
    return spark.read.schema(_STORED).parquet(hours_path).select(
        hour.alias("event_hour"), hour.cast("date").alias("event_date"), F.hour(hour).alias("hour_of_day"),
        "total_visits", "total_carts", "total_orders")


def read_late(spark: SparkSession, late_path: str) -> DataFrame:
    """The late rows as raw traffic."""
    return spark.read.schema(_STORED).parquet(late_path).select(
        F.timestamp_micros("at_us").cast("timestamp_ntz").alias("event_time"), "traffic_id", "item_in_cart", "product_id", "order_id")
