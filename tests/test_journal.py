"""A run that is lost after any step is completed by the next one; changes are told by content."""

import datetime as dt
import re

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from lakemart import schemas as S
from lakemart.operators import changes
from lakemart.plans import runs
from lakemart.plans.journal import WHOLE, Journal
from lakemart.plans.pipeline import (FACT, FUNNEL, HOURLY, ORDER_OUTPUTS, ORDER_TABLES, SPECS, TRAFFIC_OUTPUTS, UNSPECIFIED,
                                     Pipeline)
from lakemart.sources import sinks

T = dt.datetime
TABLES = [*SPECS, *UNSPECIFIED]


class Raw:
    def __init__(self, spark, orders, traffic):
        self.raw_products = spark.createDataFrame([(1, "p", "c", "s", "b", 1000, 600), (2, "q", "c", "s", "b", 50, 20)], S.RAW_PRODUCTS)
        self.raw_employees = spark.createDataFrame([(5, "e", "F", 30, dt.date(2020, 1, 1), None)], S.RAW_EMPLOYEES)
        self.raw_payroll = spark.createDataFrame([(5, 30000, dt.date(2024, 1, 1))], S.RAW_PAYROLL)
        self.raw_orders = spark.createDataFrame(orders, S.RAW_ORDERS)
        self.raw_traffic = spark.createDataFrame(traffic, S.RAW_TRAFFIC)


def order(i, when, product=1, quantity=1, city="Brno", review=4):
    return (i, product, quantity, "None", 0, 5, when, city, review)


def event(when, visitor, cart="yes", product=1, bought=None):
    return (when, visitor, cart, product, bought)


FIRST = [order(1, T(2024, 1, 5, 10)), order(2, T(2024, 2, 6, 10), city="Praha"), order(3, T(2024, 2, 6, 11), review=1), order(4, None)]
SECOND = [order(1, T(2024, 1, 5, 10)), order(2, T(2024, 3, 1, 9), city="Praha"), order(3, T(2024, 2, 6, 11), review=5, quantity=7),
          order(5, T(2024, 1, 9, 1), product=2), order(6, T(2024, 4, 1))]
VISITS = [event(T(2024, 1, 5, 9), "T-1"), event(T(2024, 2, 6, 9), "T-2", "no"), event(T(2024, 2, 6, 9), "T-3", "yes", 2)]
LATER = [event(T(2024, 1, 5, 9), "T-1"), event(T(2024, 2, 6, 9), "T-2", "yes"), event(T(2024, 2, 6, 9), "T-3", "no", 2),
         event(T(2024, 3, 1, 8), "T-4", bought=2)]


def content(p):
    return {t: sorted(map(str, p.gold(t).select(*sorted(p.gold(t).columns)).collect())) for t in TABLES}


@pytest.fixture(scope="module", autouse=True)
def small_jobs(spark):
    """The tables here have some rows each."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    """What full runs over either state of the source give, and the steps of a run."""
    steps, out = [], []
    for k, (orders, visits) in enumerate(((FIRST, VISITS), (SECOND, LATER))):
        p = Pipeline(spark, str(tmp_path_factory.mktemp(f"whole{k}")), steps.append)
        p.run(Raw(spark, orders, visits))
        out.append(content(p))
    steps = list(dict.fromkeys(steps))
    assert {*TABLES, "orders_ledger", "traffic_ledger"} == {*steps}
    return out, steps


def test_runs_lost_after_every_step_are_completed_by_the_next(spark, tmp_path, whole):
    """Each run of a chain is lost one step later than the one before, over a source that goes to
    and fro; then one runs through."""
    (before, after), steps = whole
    folder, states = str(tmp_path), ((FIRST, VISITS), (SECOND, LATER))
    for k, step in enumerate(steps[:steps.index("fact_orders_gold") + 2]):  # a first run that never ends
        runs.broken_run(spark, folder, Raw(spark, *states[k % 2]), step)
    Pipeline(spark, folder).run(Raw(spark, *states[0]))
    assert content(Pipeline(spark, folder)) == before
    for k, step in enumerate(steps):
        runs.broken_run(spark, folder, Raw(spark, *states[1 - k % 2]), step)
    Pipeline(spark, folder).run(Raw(spark, *states[1]))
    assert content(Pipeline(spark, folder)) == after
    assert not Journal(spark, f"{folder}/_journal").pending


@pytest.mark.parametrize("step", ["mart_city_sales", "traffic_ledger"])
def test_a_broken_run_whose_source_goes_back_is_undone(spark, tmp_path, whole, step):
    """The digests are then those of the ledger again; the journal alone knows what is due."""
    (before, _), _ = whole
    folder = str(tmp_path)
    Pipeline(spark, folder).run(Raw(spark, FIRST, VISITS))
    runs.broken_run(spark, folder, Raw(spark, SECOND, LATER), step)
    Pipeline(spark, folder).run(Raw(spark, FIRST, VISITS))
    assert content(Pipeline(spark, folder)) == before


def test_a_driver_lost_between_two_moves(spark, tmp_path, monkeypatch, whole):
    (_, after), _ = whole
    move, left = sinks.Files.move, [0]

    def lost(self, source, target):
        left[0] -= 1
        if left[0] == 0:
            raise runs.BrokenOff(target)
        move(self, source, target)

    folder = str(tmp_path)
    Pipeline(spark, folder).run(Raw(spark, FIRST, VISITS))
    for k in (5, 12, 19):
        left[0] = k
        with monkeypatch.context() as m:
            m.setattr(sinks.Files, "move", lost)
            with pytest.raises(runs.BrokenOff):
                Pipeline(spark, folder).run(Raw(spark, SECOND, LATER))
    p = Pipeline(spark, folder)
    p.run(Raw(spark, SECOND, LATER))
    assert content(p) == after


def test_a_run_without_changes_rewrites_no_fact_and_no_mart(spark, tmp_path):
    folder = str(tmp_path)
    Pipeline(spark, folder).run(Raw(spark, FIRST, VISITS))
    steps = []
    Pipeline(spark, folder, steps.append).run(Raw(spark, FIRST, VISITS))
    assert not {*ORDER_TABLES, *ORDER_OUTPUTS, *TRAFFIC_OUTPUTS, HOURLY, FUNNEL} & {*steps}


def test_only_touched_months_are_rebuilt(spark, tmp_path):
    folder = str(tmp_path)
    Pipeline(spark, folder).run(Raw(spark, FIRST, VISITS))
    planned = []
    plan = Journal.plan

    class Watched(Pipeline):
        def _journal(self):
            journal = super()._journal()
            journal.plan = lambda tables: (planned.append(tables), plan(journal, tables))
            return journal

    corrected = [order(3, T(2024, 2, 6, 11), review=2) if o[0] == 3 else o for o in FIRST]  # same time, other review
    Watched(spark, folder).run(Raw(spark, corrected, VISITS))
    assert [t["mart_city_sales"] for t in planned] == [[dt.date(2024, 2, 1)]]


def test_journal_keeps_whole_tables_and_null_periods(spark, tmp_path):
    folder = f"{tmp_path}/j"
    day = dt.date(2024, 1, 1)
    Journal(spark, folder).plan({"a": [day, None], "b": None, "c": []})
    j = Journal(spark, folder)
    assert j.pending == {"a": [None, day], "b": WHOLE}
    j.plan({"a": [day], "b": [day]})
    j.done("b")
    assert Journal(spark, folder).todo("a") == (True, [None, day]) and Journal(spark, folder).todo("b") == (False, [])
    assert len(sinks.Files(spark, folder).children(folder)) == 1


def test_digests_see_what_counts_and_times_do_not(spark):
    schema = "k long, t timestamp_ntz, v string, w string"
    day = F.col("t").cast("date")
    base = [(1, T(2024, 1, 1, 1), "a", "x"), (2, T(2024, 1, 1, 2), "b", "y"), (3, T(2024, 1, 2), None, "z"), (4, None, "d", None)]
    digest = lambda rows: changes.period_digests(spark.createDataFrame(rows, schema), day)
    differ = lambda rows: sorted((r[0] for r in changes.changed_periods(digest(rows), digest(base)).collect()), key=str)
    one, two = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    assert differ(base[::-1]) == []
    assert differ([(1, T(2024, 1, 1, 1), "b", "x"), (2, T(2024, 1, 1, 2), "a", "y"), *base[2:]]) == [one]  # traded values
    assert differ([*base[:2], (3, T(2024, 1, 2), "z", None), base[3]]) == [two]  # a value that changed its column
    assert differ([*base, base[0]]) == [one]
    assert differ(base[1:]) == [one]
    assert differ([*base[:3], (4, None, "e", None)]) == [None]
    assert differ([*base[:3], (4, T(2024, 1, 2), "d", None)]) == [two, None]


def test_changed_keys_and_their_current_rows(spark):
    schema = "k long, t timestamp_ntz, v string"
    hashed = lambda rows: (df := spark.createDataFrame(rows, schema)).withColumn("row_hash", changes.row_hash(df.columns))
    stored = hashed([(1, T(2024, 1, 1), "a"), (2, T(2024, 1, 1), "b"), (None, T(2024, 1, 1), "n"), (5, T(2024, 1, 1), "e")])
    source = hashed([(1, T(2024, 1, 1), "a"), (2, T(2024, 1, 1), "c"), (None, T(2024, 1, 1), "m"), (3, T(2024, 1, 1), "d"),
                     (3, T(2023, 1, 1), "old"), (5, T(2023, 5, 5), "older version")])
    in_day = F.col("t") >= F.lit(T(2024, 1, 1)).cast("timestamp_ntz")
    changed, current = changes.source_changes(source, stored, in_day, ["k"], "t")
    assert sorted((r.k for r in changed.collect()), key=str) == [2, 3, 5, None]
    assert sorted(((r.k, r.v) for r in current.collect()), key=str) == [(2, "c"), (3, "d"), (5, "older version"), (None, "m")]


def test_runs_broadcast_nothing_that_grows(spark, tmp_path, monkeypatch):
    """Tables of this size are broadcast wherever a join is left to Spark. In a crashed and a correcting run
    only the seasons of the traffic forecast are, at most 12 and 7 rows."""
    def stored(name, orders, visits):
        raw = Raw(spark, orders, visits)
        for table, df in list(vars(raw).items()):
            df.write.parquet(f"{tmp_path}/{name}/{table}")
            setattr(raw, table, spark.read.parquet(f"{tmp_path}/{name}/{table}"))
        return raw

    first, second, plans = stored("first", FIRST, VISITS), stored("second", SECOND, LATER), []

    def watch(cls, name, frame):
        run = getattr(cls, name)

        def watched(self, *args, **kwargs):
            plans.append(frame(self)._jdf.queryExecution().executedPlan().toString())
            return run(self, *args, **kwargs)
        monkeypatch.setattr(cls, name, watched)

    for name in ("save", "parquet"):
        watch(DataFrameWriter, name, lambda writer: writer._df)
    for name in ("checkpoint", "collect"):
        watch(type(spark.range(1)), name, lambda df: df)
    folder = f"{tmp_path}/lake"
    runs.broken_run(spark, folder, first, FACT)
    Pipeline(spark, folder).run(first)
    runs.broken_run(spark, folder, second, "mart_city_sales")
    Pipeline(spark, folder).run(second)
    joins = [line.strip() for plan in plans for line in plan.splitlines() if "Join" in line]
    keys = {(re.findall(r"Broadcast\w*Join \[(\w+)#", line) or [line])[0] for line in joins if "Broadcast" in line}
    assert keys == {"moy", "dow"} and any("ShuffledHashJoin" in line for line in joins)
