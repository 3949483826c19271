"""flowgrid — Spark-native station x hour mobility-flow analytics.

Every operator is a function from DataFrames to DataFrames (or Columns);
the heavy lifting is left to Catalyst / Tungsten.  Sub-packages:

* ``functions``  column expressions (station ids, durations, dates, URLs …)
* ``sources``    readers, schema enforcement and writers
* ``operators``  cleaning, flow counting, windows, series, reshaping,
                 profiling, data-quality checks, drift tests, learning
* ``plans``      composed queries (the grid) and the query catalog
* ``streaming``  Structured-Streaming forms of the hourly counters
"""

from flowgrid.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
