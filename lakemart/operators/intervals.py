"""Stabbing queries over employment intervals, at instants, by a dyadic index.

A dyadic segment (level, node) covers the instants [node * 2^level, (node + 1) * 2^level) in
microseconds. An interval is the disjoint union of at most two segments of each level, and an
instant lies in exactly one segment of each level, its ancestors. Who is employed at an
instant is therefore an equi-join of the instant's ancestors with the intervals' segments:
no inequality join, and no pairs but those of the answer.

Rosters only change where an interval begins or ends. All orders between two such change
points share one roster class, which the change point that begins it names. Its totals are
looked up once for each class, from the totals of its ancestors; orders find their class by
their day, which knows the class that it begins in and the changes inside it. So an order
costs one equi-join, whatever the staff, and the roster itself is kept once: as segments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.functions.exprs import col
from lakemart.session import materialize

#: Instants lie below 2^TOP microseconds (the year 4253); an open interval reaches up to it.
TOP = 56
DAY = 86_400_000_000


def micros(ts) -> Column:
    """A time (date, timestamp without zone) as microseconds, read as UTC."""
    return F.unix_micros(col(ts).cast("timestamp_ntz").cast("timestamp"))


def instant(at) -> Column:
    return F.timestamp_micros(col(at)).cast("timestamp_ntz")


def _bounds(intervals: DataFrame, id_col: str, start: str, end: str) -> DataFrame:
    """id, lo, hi of the intervals [start, end) that hold an instant; no end means TOP."""
    hi = F.coalesce(micros(end), F.lit(1 << TOP))
    return intervals.select(F.col(id_col).alias("id"), micros(start).alias("lo"), hi.alias("hi")).filter("lo < hi")


def segments(intervals: DataFrame, id_col: str = "employee_id", start: str = "hire_date", end: str = "exit_date") -> DataFrame:
    """id, level, node: the canonical segments of each interval, at most two of a level."""
    def of(level):
        low = -F.call_function("shiftright", -F.col("lo"), level)
        high = F.call_function("shiftright", F.col("hi"), level)
        pick = lambda node, odd: F.when((low < high) & (odd % 2 != 0), F.struct(level.alias("level"), node.alias("node")))
        return F.array(pick(low, low), pick(high - 1, high))

    every = F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(TOP)), of)))
    return (_bounds(intervals, id_col, start, end).select("id", F.explode(every).alias("s"))
            .select("id", "s.level", "s.node"))


def with_ancestors(instants: DataFrame, at: str = "at") -> DataFrame:
    """One row per instant and level: the segment that holds it."""
    levels = F.transform(F.sequence(F.lit(0), F.lit(TOP)), lambda k: F.struct(
        k.alias("level"), F.call_function("shiftright", F.col(at), k).alias("node")))
    return instants.select("*", F.explode(levels).alias("_s")).select("*", "_s.level", "_s.node").drop("_s")


def change_points(intervals: DataFrame, start: str = "hire_date", end: str = "exit_date", id_col: str = "employee_id") -> DataFrame:
    """at: the instants where some interval begins or ends, each once."""
    b = _bounds(intervals, id_col, start, end)
    return b.select(F.explode(F.array("lo", "hi")).alias("at")).filter(F.col("at") < (1 << TOP)).distinct()


def class_totals(points: DataFrame, segs: DataFrame) -> DataFrame:
    """at, n, id_sum: how many intervals hold each change point, and the sum of their ids."""
    totals = segs.groupBy("level", "node").agg(F.count("*").alias("n"), F.sum("id").alias("id_sum"))
    found = with_ancestors(points).join(totals, ["level", "node"]).groupBy("at").agg(F.sum("n").alias("n"), F.sum("id_sum").alias("id_sum"))
    return points.join(found, "at", "left").select("at", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("id_sum", F.lit(0)).alias("id_sum"))


def _days(classes: DataFrame, asked: DataFrame) -> DataFrame:
    """day (its number), carry (the class that it begins in) and changes (the classes that begin in
    it, ascending) for every day asked for. Calendar-sized: the last class before a day comes from
    its own year and, over one row per year, from the years before."""
    one = F.struct("at", "n", "id_sum").alias("c")
    inside = classes.select(F.floor(F.col("at") / DAY).cast("bigint").alias("day"), one).groupBy("day").agg(
        F.sort_array(F.collect_list("c")).alias("changes"))
    # Read several times below; one row per day.
    line = materialize(asked.select("day").unionByName(inside.select("day")).distinct().join(inside, "day", "left")
                       .withColumn("last", F.element_at("changes", -1)).withColumn("year", F.floor(F.col("day") / 366)))
    years = line.groupBy("year").agg(F.max("last").alias("last")).filter("last IS NOT NULL")
    top = line.agg(F.max("year")).scalar()
    earlier = (years.filter(F.col("year") < top).select(F.explode(F.sequence(F.col("year") + 1, top)).alias("year"), "last")
               .groupBy("year").agg(F.max("last").alias("before")))
    within = Window.partitionBy("year").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    return (line.withColumn("own", F.max("last").over(within)).join(earlier, "year", "left")
            .select("day", F.coalesce("own", "before").alias("carry"), "changes"))


def rosters_of_orders(orders: DataFrame, staff: DataFrame, ts_col: str = "order_timestamp", order_id: str = "order_id",
                      id_col: str = "employee_id", start: str = "hire_date", end: str = "exit_date") -> DataFrame:
    """Each order with its roster_class (the last change before or at its instant; NULL before the
    first and without a time), active_staff_count and employee_id_sum of that roster."""
    segs = segments(staff, id_col, start, end)
    classes = materialize(class_totals(change_points(staff, start, end, id_col), segs))
    o = orders.select(order_id, ts_col, micros(ts_col).alias("_t")).withColumn("day", F.floor(F.col("_t") / DAY).cast("bigint"))
    days = _days(classes, o.select("day").filter("day IS NOT NULL").distinct())
    passed = F.filter("changes", lambda c: c["at"] <= F.col("_t"))
    found = F.coalesce(F.try_element_at(passed, F.lit(-1)), F.col("carry"))
    return (o.join(days, "day", "left").withColumn("_c", found)
            .select(order_id, ts_col, instant("_c.at").alias("roster_class"), F.coalesce("_c.n", F.lit(0)).alias("active_staff_count"),
                    F.coalesce("_c.id_sum", F.lit(0)).alias("employee_id_sum")))


def staff_at(instants: DataFrame, staff: DataFrame, ts_col: str = "order_timestamp", id_col: str = "employee_id",
             start: str = "hire_date", end: str = "exit_date") -> DataFrame:
    """The rows of ``instants`` with each member employed then (``id_col``): the roster list. One
    equi-join over the ancestors of the distinct instants."""
    segs = segments(staff, id_col, start, end).withColumnRenamed("id", id_col)
    asked = instants.select(micros(ts_col).alias("at")).filter("at IS NOT NULL").distinct()
    members = with_ancestors(asked).join(segs, ["level", "node"]).select("at", id_col)
    return instants.withColumn("at", micros(ts_col)).join(members, "at").drop("at")
