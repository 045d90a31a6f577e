"""surgeflow: early-warning panel analytics as plain Spark DataFrame functions.

Sub-packages
------------
functions  scalar column expressions (coercion, calendar, null/NaN rules)
sources    typed readers / writers and the driver-table adapters
operators  cleaning, panel, labels, splits, metrics, statistics, models
plans      the registered query catalog and its DuckDB twins
llm        training-data operators (warc, packing, dedup, decontamination, scoring)
"""

__version__ = "0.1.0"
