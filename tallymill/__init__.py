"""Frequency and severity analytics for large tables of timestamped incidents.

Everything here takes and returns DataFrames on the caller's session:

* ``sources``    raw CSV, Parquet and summary readers, fixed schemas
* ``sinks``      CSV / Parquet / JSON writers and metric tables
* ``functions``  column expressions (timestamps, labels, rounding)
* ``operators``  reusable DataFrame operators, column names as parameters
* ``plans``      the reports, chart tables and end-to-end jobs
* ``workloads``  the query catalogue over the driver's tables, and its SQL oracle
"""

__version__ = "0.1.0"
