"""Incremental maintenance of the four incremental models by change set.

New rows touch some taxa; a model row depends on the rows of its own taxon only. So the
staged rows and the four models are kept in parts by taxon, and a run

1. stages the new rows that are not stored yet (an anti-join with the touched parts only)
   and appends them as a version of their parts; the rows are not shuffled for that;
2. rebuilds the models of the touched parts from the staged rows of those parts, and of
   parts that were last built for another ``as_of``, whose grids end elsewhere;
3. commits each model with one write. Parts that nothing touched are neither read nor
   written, and what is read are the folders of the touched parts.

A run that dies is repeated with the same rows: those already staged are left out, and a
model part is rebuilt if it was built from fewer staged versions than there are.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from fieldnotes.operators import incremental, staging
from fieldnotes.operators.versions import PART, PartTable, part_of
from fieldnotes.params import Params
from fieldnotes.plans.models import Models
from fieldnotes.schemas import RAW_OBSERVATION
from fieldnotes.session import kept

#: model name -> Models attribute; each has one taxon per row
MODELS = {
    "species": "species",
    "species_to_locations": "species_to_locations",
    "monthly_species_summary": "monthly_species_panel",
    "monthly_species_summary_by_location": "monthly_species_location_panel",
}
PARTS = 64


class Maintained:
    """The staged rows and the models under ``root``, in ``parts`` parts (fixed when the first run writes them)."""

    def __init__(self, spark: SparkSession, root: str, params: Params, parts: int = PARTS, only: tuple[str, ...] = tuple(MODELS)) -> None:
        self.spark, self.root, self.parts = spark, root.rstrip("/"), parts
        self.params = dataclasses.replace(params, order_output=False)
        self.only = only
        self.staged = PartTable(spark, f"{self.root}/stg_observations")

    def table(self, model: str) -> PartTable:
        return PartTable(self.spark, f"{self.root}/{model}")

    def in_parts(self, df: DataFrame) -> DataFrame:
        return df.withColumn(PART, part_of(self.parts, "taxon_id")).hint("rebalance", PART)

    def stage(self, raw: DataFrame) -> None:
        """Appends the rows of ``raw`` that are not staged yet; they go to the files of their parts without a shuffle."""
        part = part_of(self.parts, "taxon_id")
        if self.staged.versions():
            raw = kept(raw, "batch")
            new = staging.stage_observations(raw, self.params)
            touched = [r[0] for r in new.select(part).distinct().collect()]  # at most ``parts`` numbers
            stored = self.staged.read(new.schema, touched, every_version=True)
            new = new.join(incremental.known_keys(new.select("id"), stored.select("id")), "id", "left_anti").select(*new.columns)
        else:
            new = staging.stage_observations(raw, self.params)
        self.staged.write(new.withColumn(PART, part))

    def refresh(self) -> dict[str, list[int]]:
        """Rebuilds what is behind; the parts that were rebuilt, by model."""
        seen: dict[int, int] = {}
        for v in self.staged.versions():
            seen[v.part] = max(seen.get(v.part, 0), v.version)
        done = {}
        for name in self.only:
            table, stamps = self.table(name), {p: f"{self.params.as_of.isoformat()} {v}" for p, v in seen.items()}
            held = table.newest()
            behind = sorted(p for p, stamp in stamps.items() if p not in held or held[p].stamp != stamp)
            if behind:
                table.write(self.in_parts(self.model(name, behind)), {p: stamps[p] for p in behind})
            done[name] = behind
        return done

    def model(self, name: str, parts: list[int]) -> DataFrame:
        """A model of the taxa of ``parts``, from the staged rows of these parts alone."""
        staged = self.staged.read(self.staged_schema(), parts, every_version=True)
        return getattr(Models(self.spark, None, self.params, staged=staged), MODELS[name])

    def staged_schema(self) -> StructType:
        return staging.stage_observations(self.spark.createDataFrame([], RAW_OBSERVATION), self.params).schema

    def run(self, raw: DataFrame) -> dict[str, list[int]]:
        """Takes up new rows of the log and brings the models up to date."""
        self.stage(raw)
        return self.refresh()

    def read(self, name: str) -> DataFrame:
        """The stored model."""
        return self.table(name).read(self.model(name, []).schema)
