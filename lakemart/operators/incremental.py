"""Delta-load (incremental) operators and the key-based upsert.

Watermarks are lazy scalar subqueries (``DataFrame.scalar()``) that never
yield NULL: an empty target gives the least value, so the predicate stays a
plain comparison of a column with a scalar, which Catalyst hands to the
parquet scan. Row groups are skipped by DATE columns, not by
``timestamp_ntz`` ones; where the source has a DATE column beside its
timestamp (the stored fact's ``order_month``), pass it as ``date_col``.

Boundary rules (see the README, "Incremental rules"):

* row watermark: ``ts > MAX(target.ts)``; an empty target loads everything.
  Rows that are late, tied with the watermark or without a timestamp are
  not above it: ``unstored_rows`` finds them by key, ``late_rows`` sets them
  aside.
* bucketed marts: the latest stored bucket is recomputed whole,
  ``ts >= MAX(bucket)``; ``strict=True`` reproduces the legacy
  ``ts > MAX(bucket_start)`` rule that loses rows exactly on the boundary.
* upsert: newest row per key wins inside the delta; the delta replaces
  target rows with the same key (NULL-safe key match).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.exprs import col


# Below any stored time: the watermark of an empty target.
LEAST_TIME = _dt.datetime(1, 1, 1)


def watermark(target: DataFrame, column: str) -> Column:
    """``(SELECT MAX(column) FROM target)`` as a lazy scalar Column."""
    return target.agg(F.max(column).alias("_wm")).scalar()


def _time_mark(target: DataFrame, column: str, kind: str, back: str | None = None, unit: str | None = None) -> Column:
    """The watermark as one value of type ``kind``, never NULL; the subquery holds all of the arithmetic."""
    top = F.max(column).cast("timestamp_ntz")
    if back:
        top = top - F.expr(f"INTERVAL {back}")
    if unit:
        top = F.trunc(top.cast("date"), unit)
    return target.agg(F.coalesce(top.cast(kind), F.lit(LEAST_TIME).cast("timestamp_ntz").cast(kind)).alias("_wm")).scalar()


def high_watermark_delta(source: DataFrame, target: DataFrame | None, ts_col: str,
                         target_col: str | None = None, lookback: str | None = None,
                         date_col: str | None = None) -> DataFrame:
    """Rows of ``source`` newer than the target's high watermark.

    ``target is None`` (first run) or an empty target returns every row, those
    without a time included. ``lookback`` (e.g. ``"2 hours"``) re-reads a trailing
    window; combine it with :func:`upsert` to stay idempotent. ``date_col`` names a
    DATE column that holds the month or day of ``ts_col``: its predicate skips files.
    """
    if target is None:
        return source
    kind = source.schema[ts_col].dataType.simpleString()
    mark = _time_mark(target, target_col or ts_col, kind, lookback)
    out = source.filter(col(ts_col) > mark)
    if date_col:
        out = out.filter(col(date_col) >= _time_mark(target, target_col or ts_col, "date", lookback, "MM"))
    return out


def unstored_rows(source: DataFrame, target: DataFrame, keys: list[str], ts_col: str) -> DataFrame:
    """Rows whose key the target lacks, or holds in an older version only: what a run has to
    load whenever it arrives. One join over the keys and times of both sides."""
    held = target.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.max(ts_col).alias("_held"))
    cond = [source[k].eqNullSafe(held[f"_k_{k}"]) for k in keys]
    marked = source.join(held.withColumn("_there", F.lit(True)), cond, "left")
    newer = (col(ts_col) > F.col("_held")) | (F.col("_held").isNull() & col(ts_col).isNotNull())
    return marked.filter(F.col("_there").isNull() | newer).select(*source.columns)


def late_rows(source: DataFrame, target: DataFrame, ts_col: str, keys: list[str],
              target_col: str | None = None) -> DataFrame:
    """Rows that a watermark delta would lose: at or below the watermark, or without a time,
    and not stored. Rows the target holds already are not late."""
    mark = _time_mark(target, target_col or ts_col, source.schema[ts_col].dataType.simpleString())
    held = target.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    below = source.filter(col(ts_col).isNull() | (col(ts_col) <= mark))
    return below.join(held, [below[k].eqNullSafe(held[f"_k_{k}"]) for k in keys], "left_anti")


def id_watermark_delta(source: DataFrame, target: DataFrame | None, id_col: str,
                       target_col: str | None = None) -> DataFrame:
    """``id IS NOT NULL AND id > COALESCE(MAX(target.id), 0)`` then cast to bigint."""
    src = source.filter(col(id_col).isNotNull())
    if target is not None:
        wm = F.coalesce(watermark(target, target_col or id_col), F.lit(0))
        src = src.filter(col(id_col) > wm)
    return src.withColumn(id_col, col(id_col).cast("bigint"))


def next_period_start(target: DataFrame | None, period_col: str, fallback: Column) -> Column:
    """First month to generate: the month after the last stored one, else ``fallback``."""
    if target is None:
        return F.trunc(fallback, "MM")
    last = watermark(target, period_col)
    return F.coalesce(F.add_months(F.trunc(last, "MM"), 1), F.trunc(fallback, "MM"))


def bucket_delta(source: DataFrame, target: DataFrame | None, ts_col: str, bucket_col: str,
                 strict: bool = False, date_col: str | None = None) -> DataFrame:
    """Source rows from the latest stored bucket on.

    Default: ``ts >= MAX(target.bucket)`` — the latest bucket is recomputed
    whole and replaces the stored partial aggregate.
    ``strict=True``: the legacy ``ts > MAX(bucket)`` predicate, which drops
    rows that sit exactly on the bucket start.
    """
    if target is None:
        return source
    mark = _time_mark(target, bucket_col, source.schema[ts_col].dataType.simpleString())
    # The watermark is a bucket's start, so comparing the time itself keeps the whole bucket.
    out = source.filter(col(ts_col) > mark if strict else col(ts_col) >= mark)
    if date_col:
        out = out.filter(col(date_col) >= _time_mark(target, bucket_col, "date", unit="MM"))
    return out


def latest_per_key(df: DataFrame, keys: list[str], order_cols: list[str] | None) -> DataFrame:
    """One row per key: the greatest by ``order_cols``, ties broken by the
    remaining columns (deterministic, independent of arrival order).

    Written as ``max(struct(order_cols..., other columns...))`` per key: an
    aggregate with map-side partial aggregation, so a key with very many
    versions is reduced inside every task before the shuffle instead of being
    sorted whole in one task (as a ``row_number`` window would). In the
    struct order a NULL field sorts below any value, so NULL order values
    lose, as with ``desc_nulls_last``.
    """
    order = [c for c in (order_cols or []) if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not order and not rest:
        return df.select(*keys).distinct()
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      *[F.col(c).alias(f"_r{i}") for i, c in enumerate(rest)])
    agg = df.groupBy(*keys).agg(F.max(packed).alias("_best"))
    cols = {c: F.col(f"_best._o{i}") for i, c in enumerate(order)}
    cols.update({c: F.col(f"_best._r{i}") for i, c in enumerate(rest)})
    return agg.select(*[F.col(c) if c in keys else cols[c].alias(c) for c in df.columns])


def upsert(target: DataFrame | None, delta: DataFrame, keys: list[str],
           order_cols: list[str] | None = None, dedupe: bool = True) -> DataFrame:
    """MERGE-by-key without MERGE: ``target`` minus delta keys, plus the delta.

    The key match is NULL-safe (``<=>``), so a NULL key (e.g. an order
    without a city) replaces its previous version instead of duplicating on
    every run. Running the same upsert twice is a no-op.
    """
    d = latest_per_key(delta, keys, order_cols) if dedupe else delta
    if target is None:
        return d
    dk = d.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    cond = [target[k].eqNullSafe(dk[f"_k_{k}"]) for k in keys]
    kept = target.join(dk, cond, "left_anti")
    return kept.unionByName(d.select(*target.columns))
