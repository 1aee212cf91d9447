"""playlens — listening-session analytics as lazy Spark DataFrame plans.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark
built-ins; none triggers an action except the sinks and the tree-model fits.

Sub-packages:

* ``sources``   — play-log scan (TSV), timestamp parsing, table adapters, sinks
* ``functions`` — column-level helpers (epoch seconds, calendar parts, units,
  long-form describe)
* ``operators`` — profiling, sessionization, user series, trend models,
  seasonal diagnostics and forecasts, chart tables
* ``plans``     — the query catalog (query name -> plan) and DuckDB oracles
* ``streaming`` — the session operators over a Structured Streaming source
"""

__version__ = "0.1.0"
