"""probelens: Spark-native analytics for vehicle probe readings.

Sub-packages:

* ``sources``   raw CSV ingest and validation, the ``events`` adapter,
  curated Parquet readers and writers
* ``functions`` per-row Column expressions (time parts, congestion, delay, keys)
* ``operators`` curated aggregates, the filter predicate builder, dashboard
  reports and the keyed summary upsert
* ``plans``     batch pipelines, the registered query catalog and its SQL oracle
* ``streaming`` intentionally empty (the source application has no streams)
"""

__version__ = "0.1.0"
