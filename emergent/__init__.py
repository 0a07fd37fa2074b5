"""Contrast (emerging) pattern mining and rule-based candidate discovery on Spark.

Every operator takes and returns Spark DataFrames and is built from Catalyst
expressions, joins, aggregations and windows; the only values that reach the
driver are scalars (transaction counts, itemset counts, sweep statuses).
"""

from emergent.session import checkpoint_dir, local_session

__all__ = ["checkpoint_dir", "local_session"]
