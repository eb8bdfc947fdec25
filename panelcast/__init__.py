"""panelcast: forecast-dataset building and scoring over panels of time series on Spark.

A panel is a DataFrame with one or more ``series`` key columns, a ``time`` column
(DATE for day/month units, TIMESTAMP for hours) and value columns.  Every
operator is a lazy DataFrame plan built from built-in functions; windows are
always partitioned by the series key.
"""

from panelcast.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
