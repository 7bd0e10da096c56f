"""Streaming results equal the batch models (several micro-batches, late data)."""

from collections import Counter

from pyspark.sql import functions as F

from conftest import SF001
from lakemart.operators import gold, silver
from lakemart.plans.models import Models
from lakemart.sources.fixtures import raw_traffic
from lakemart.streaming import hourly as ST


def _split_traffic(spark, scratch):
    """Traffic as three files: two in time order, then a late file with old rows."""
    rows = raw_traffic(spark, SF001)
    d, late = f"{scratch}/events_in", F.col("order_id") % 5 == 0
    cut, t = F.lit("2024-01-12").cast("timestamp_ntz"), F.col("event_time")
    parts = [rows.filter(t < cut), rows.filter((t >= cut) & ~F.coalesce(late, F.lit(False))), rows.filter((t >= cut) & late)]
    for i, p in enumerate(parts):
        p.coalesce(1).write.mode("overwrite").parquet(f"{d}/part{i}")
    return (spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", True).parquet(d))


def _rows(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_stream_hourly_mart_equals_batch(spark, scratch):
    src = _split_traffic(spark, scratch)
    q = ST.hourly_mart_stream(spark, src, f"{scratch}/silver", f"{scratch}/mart", f"{scratch}/ckpt")
    q.awaitTermination()
    assert len(q.recentProgress) >= 3
    got = ST.read_hourly_mart(spark, f"{scratch}/mart")
    want = Models(spark, SF001, traffic="raw_traffic").mart_hourly_traffic_conversion
    assert _rows(got) == _rows(want)


def test_stream_hourly_mart_takes_batches_without_rows(spark, scratch):
    """A delivery whose files hold no rows, first or later, opens no day and ends no stream."""
    rows = raw_traffic(spark, SF001)
    src = lambda: (spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1)
                   .option("recursiveFileLookup", True).parquet(f"{scratch}/in"))
    for k, part in enumerate((rows.filter("false"), rows, rows.filter("false"))):
        part.coalesce(1).write.parquet(f"{scratch}/in/{k}")
        ST.hourly_mart_stream(spark, src(), f"{scratch}/silver", f"{scratch}/mart", f"{scratch}/ckpt").awaitTermination()
        want = gold.mart_hourly_traffic_conversion(silver.stg_traffic(rows if k else part))
        got = ST.read_hourly_mart(spark, f"{scratch}/mart")
        assert got.schema.simpleString() == want.schema.simpleString() and _rows(got) == _rows(want)


def test_stream_fact_upsert_equals_batch(spark, scratch):
    m = Models(spark, SF001)
    raw = m.raw.raw_orders
    d = f"{scratch}/orders_in"
    raw.filter(F.col("order_id") % 2 == 0).coalesce(1).write.parquet(f"{d}/a")
    raw.filter(F.col("order_id") % 2 == 1).coalesce(1).write.parquet(f"{d}/b")
    raw.filter(F.col("order_id") % 7 == 0).coalesce(1).write.parquet(f"{d}/c")  # replayed rows
    src = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", True).parquet(d)
    q = ST.fact_upsert_stream(src, f"{scratch}/fact", m.stg_products, f"{scratch}/ckpt")
    q.awaitTermination()
    got = spark.read.parquet(f"{scratch}/fact").drop("order_month")
    assert _rows(got) == _rows(m.fact_orders_gold)


def test_watermarked_visits_match_batch_on_closed_hours(spark, scratch):
    src = _split_traffic(spark, scratch)
    q = (ST.hourly_visits_dropping_late(src, delay="1 hour").writeStream.outputMode("append")
         .format("parquet").option("path", f"{scratch}/visits").option("checkpointLocation", f"{scratch}/ck2")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r.event_hour: r.total_visits for r in spark.read.parquet(f"{scratch}/visits").collect()}
    batch = {r.event_hour: r.total_visits
             for r in Models(spark, SF001, traffic="raw_traffic").mart_hourly_traffic_conversion.collect()}
    assert got, "some hours close within the stream"
    # Rows of the late file that fall behind the watermark are dropped by the
    # watermark form (that is its documented limit); hours before 2024-01-12
    # come only from the first, on-time file and must match exactly.
    early = {h: v for h, v in got.items() if str(h) < "2024-01-12"}
    assert early and all(batch[h] == v for h, v in early.items())


def test_quarantine_takes_late_rows_that_are_not_stored_once(spark, scratch):
    def frame(rows):
        return spark.createDataFrame(rows, "id long, ts string").select("id", F.col("ts").cast("timestamp_ntz").alias("ts"))

    frame([(1, "2024-01-02 00:00:00"), (4, "2024-01-01 00:00:00")]).write.parquet(f"{scratch}/t")
    batch = frame([(2, "2024-01-01 00:00:00"), (3, "2024-01-03 00:00:00"), (4, "2024-01-01 00:00:00"), (5, "2024-01-02 00:00:00"), (6, None)])
    for _ in range(2):  # a repeated batch leaves its rows once
        keep = ST.quarantine_late_rows(spark, batch, f"{scratch}/t", "ts", ["id"], f"{scratch}/q", batch_id=7)
        assert [r.id for r in keep.collect()] == [3]
    assert sorted(r.id for r in spark.read.parquet(f"{scratch}/q").collect()) == [2, 5, 6]


def test_stateful_hours_close_once_and_late_rows_leave_by_the_side(spark, scratch):
    """Four deliveries, the query restarted for each; a repeated delivery of no files changes nothing."""
    import datetime as dt

    from lakemart import schemas as S
    from lakemart.streaming import stateful

    T = dt.datetime
    src = lambda: spark.readStream.schema(S.RAW_TRAFFIC).option("recursiveFileLookup", True).parquet(f"{scratch}/in")

    def deliver(k, rows):
        if rows:
            spark.createDataFrame(rows, S.RAW_TRAFFIC).write.parquet(f"{scratch}/in/{k}")
        stateful.stateful_hourly_stream(spark, src(), f"{scratch}/hours", f"{scratch}/late", f"{scratch}/check").awaitTermination()
        hours = {r.event_hour.hour: (r.total_visits, r.total_carts, r.total_orders) for r in stateful.read_hours(spark, f"{scratch}/hours").collect()}
        return hours, sorted(r.traffic_id for r in stateful.read_late(spark, f"{scratch}/late").collect())

    before = spark.conf.get(stateful.PROVIDER)
    first = [(T(2024, 1, 1, 1, 5), "a", "yes", 1, None), (T(2024, 1, 1, 1, 6), "a", "no", 1, 7), (T(2024, 1, 1, 2, 5), "b", "yes", 1, None),
             (None, "c", "yes", 1, None)]
    assert deliver(0, first) == ({}, [])  # the watermark stands at 0:05
    assert deliver(1, [(T(2024, 1, 1, 2, 9), "b", "yes", 1, 8), (T(2024, 1, 1, 9, 5), "a", "no", 1, None), (T(2024, 1, 1, 1, 30), "z", "yes", 1, 7)]) == (
        {1: (2, 2, 1), 2: (1, 2, 1)}, [])
    assert deliver(2, [(T(2024, 1, 1, 1, 7), "late", "yes", 1, None), (T(2024, 1, 1, 8, 7), "open", "no", 1, None)]) == (
        {1: (2, 2, 1), 2: (1, 2, 1)}, ["late"])
    done = ({1: (2, 2, 1), 2: (1, 2, 1), 8: (1, 0, 0), 9: (1, 0, 0)}, ["late"])
    assert deliver(3, [(T(2024, 2, 1), "end", "no", 1, None)]) == done
    assert deliver(4, []) == done
    assert spark.conf.get(stateful.PROVIDER) == before


def test_a_delivery_of_many_files_is_one_micro_batch(spark, scratch):
    """The number of batches, each of which rewrites what it touches, follows the deliveries, not the files."""
    from lakemart.plans.catalog import _deliver

    sizes = []
    start = lambda src: (src.writeStream.foreachBatch(lambda batch, _: sizes.append(batch.count()))
                         .option("checkpointLocation", f"{scratch}/ckpt").trigger(availableNow=True).start())
    n = F.col("id")
    _deliver(spark.range(0, 100, 1, 7), f"{scratch}/in", [n % 5 < 3, n % 5 == 3, n % 5 == 4], start)
    assert sizes == [60, 20, 20]
