"""All named queries over the test tables, with their DuckDB oracles.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``ORACLES[name]`` is the
SQL that computes the same rows from the same tables. Names without an oracle
are checked on row counts only (stateful streaming, fitted forecasts, sinks).
"""

from __future__ import annotations

from fieldnotes.plans import audit_queries, forecast_queries, ingest_queries, maintenance_queries, model_queries, operator_queries  # noqa: F401
from fieldnotes.plans.base import ORACLES, QUERIES, models, register

__all__ = ["ORACLES", "QUERIES", "models", "register"]
