"""lakemart — a Spark-native retail analytics pipeline.

Raw product, employee, payroll, traffic and order tables go through a
cleaned (silver) layer into gold dimensions, an order fact and marts, with
incremental (delta) builds, idempotent upserts, interval joins, z-score
anomaly flags and closed-form seasonal forecasts. Every operator is a plain
function ``f(df, ..., **params) -> DataFrame`` that leaves physical planning
to Catalyst and AQE.
"""

from lakemart.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
