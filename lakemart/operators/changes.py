"""What has changed in a source since it was last read, told by content.

A period (a day) has a digest: the number of its rows, and the sum and the exclusive or of
two independent 64-bit hashes of each row. Both do not depend on the order of the rows, and
both are partial aggregates, so a task sends one row per period. A row that is corrected in
place, two rows that trade values, a deletion and a duplicate change the digest of their
periods, a mere count does not show the first two.

Inside the changed periods, a row hash stored with the target tells the keys whose rows
differ. Only those are read again: unchanged rows of a changed day cost one comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.operators.incremental import latest_per_key
from lakemart.session import materialize, shuffled

ROW_HASH = "row_hash"


def row_hash(columns: list[str], salt: str = "") -> Column:
    """64-bit hash of a row. ``xxhash64`` skips nulls, so where they stand is hashed too."""
    return F.xxhash64(F.lit(salt), *columns, *[F.col(c).isNull() for c in columns])


def period_digests(df: DataFrame, period: Column) -> DataFrame:
    """period, n, total, mix: one row per period, NULL among them."""
    rows = df.select(period.alias("period"), row_hash(df.columns).alias("_h"), row_hash(df.columns, "mix").alias("_m"))
    return rows.groupBy("period").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_h").cast("decimal(20,0)")).alias("total"),
                                      F.bit_xor("_m").alias("mix"))


def changed_periods(now: DataFrame, before: DataFrame) -> DataFrame:
    """The periods whose digests differ, those that only one side has included."""
    old = before.select(F.col("period").alias("_p"), *(F.col(c).alias(f"_{c}") for c in ("n", "total", "mix")))
    both = now.join(old, now["period"].eqNullSafe(old["_p"]), "full")
    same = F.col("n").eqNullSafe(F.col("_n")) & F.col("total").eqNullSafe(F.col("_total")) & F.col("mix").eqNullSafe(F.col("_mix"))
    return both.filter(~same).select(F.coalesce("period", "_p").alias("period"))


def changed_keys(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose rows differ between the two frames, both with ``row_hash``: new, corrected and
    gone ones. A grouping, not a join: NULL keys compare like any other."""
    side = lambda df, here: df.select(*keys, ROW_HASH, F.lit(here).alias("_s"), F.lit(not here).alias("_t"))
    versions = side(source, True).unionByName(side(target, False)).groupBy(*keys, ROW_HASH).agg(
        F.bool_or("_s").alias("_s"), F.bool_or("_t").alias("_t"))
    return versions.filter(~(F.col("_s") & F.col("_t"))).select(*keys).distinct()


def rows_of_keys(df: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``df`` whose keys are among ``wanted`` (NULL-safe)."""
    named = shuffled(wanted.select(*[F.col(k).alias(f"_k_{k}") for k in keys]))
    return df.join(named, [df[k].eqNullSafe(named[f"_k_{k}"]) for k in keys], "left_semi")


def current_rows(source: DataFrame, changed: DataFrame, keys: list[str], ts_col: str) -> DataFrame:
    """The version that counts now of each changed key, from the whole source: the newest by
    ``ts_col``. A key without a row is gone."""
    return latest_per_key(rows_of_keys(source, changed, keys), keys, [ts_col])


def source_changes(source: DataFrame, target: DataFrame, in_changed: Column, keys: list[str], ts_col: str) -> tuple[DataFrame, DataFrame]:
    """(changed keys, their current rows). ``in_changed`` is a condition on ``ts_col`` that both
    frames can answer: the row lies in a period whose digest has changed."""
    changed = materialize(changed_keys(source.filter(in_changed), target.filter(in_changed), keys))
    return changed, current_rows(source, changed, keys, ts_col)
