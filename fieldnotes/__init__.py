"""fieldnotes: Spark-native analytics over timestamped, located observations.

Layers (each a set of DataFrame -> DataFrame functions):

* ``sources``   - readers for landed API pages, stored tables, and the
                  test-data mapping that turns the TPC-H-like tables into
                  raw observation versions.
* ``functions`` - column expressions (surrogate keys, row ids, calendar
                  helpers, null-safe arithmetic, array parsing).
* ``operators`` - staging, spines, dimensions, rollups, the dense panel
                  job, incremental load helpers and forecasting.
* ``plans``     - the model graph wired end to end, plus the registry of
                  named queries and their DuckDB oracle SQL.
* ``streaming`` - the incremental ingest as a Structured Streaming job.
"""

from fieldnotes.params import Params

__all__ = ["Params"]
