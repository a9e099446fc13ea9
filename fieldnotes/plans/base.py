"""Registry primitives shared by the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldnotes.params import FIXTURE_PARAMS, Params
from fieldnotes.plans.models import Models
from fieldnotes.sources.testdata import raw_observations

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Register a query builder under ``name`` with its oracle SQL (or none)."""
    def wrap(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name!r}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return wrap


def models(spark: SparkSession, sf_dir: str, params: Params = FIXTURE_PARAMS) -> Models:
    """The model graph over the test tables."""
    return Models(spark, raw_observations(spark, sf_dir, params), params)
