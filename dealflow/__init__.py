"""dealflow - sales-pipeline analytics as lazy Spark DataFrame operators.

Layers: ``sources`` (scans, dimensions, sinks), ``functions`` (Column helpers),
``operators`` (staging, facts, metrics, report, quality, reconciliation, buckets),
``plans`` (stand-in tables derived from the driver data, the query registry and the
DuckDB oracles), ``jobs`` (batch jobs over a real landing).
"""

__version__ = "0.1.0"
