"""skymetrics: Spark-native analytics over hourly station observations.

Every public operator is a pure ``DataFrame -> DataFrame`` function.  None of
them collects, caches or stops the session; keys default to ``("Station",)`` so
all stations are processed in one job.
"""

__version__ = "0.1.0"
