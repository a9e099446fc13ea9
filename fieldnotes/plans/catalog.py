"""Models as catalog views or as catalog tables bucketed by entity.

Each model is a view unless a caller asks for a table. A table is bucketed and sorted by
the entity its windows are partitioned by, so what is built on it (a window or a grouping
by entity, a join on the entity) reads it without an exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from fieldnotes.operators import panel, rollups
from fieldnotes.plans.models import Models

#: catalog name -> (Models attribute, entity, period)
ENTITY_MODELS = {
    "species_day": ("daily_species_panel", "taxon_id", "date_day_observed"),
    "species_month": ("monthly_species_panel", "taxon_id", "date_month_observed"),
    "species_location_month": ("monthly_species_location_panel", "species_location_id", "date_month_observed"),
    "species_month_counts": ("monthly_species_counts", "taxon_id", "date_month_observed"),
}
BUCKETS = 16


def materialise(models: Models, kinds: dict[str, str], prefix: str = "", buckets: int = BUCKETS, location: str | None = None) -> dict[str, str]:
    """Puts the models that ``kinds`` names into the catalog, each as a "view" or a "table"; returns their catalog names.

    ``location``: a folder for the tables' files (else the warehouse). A view is of this session and is planned anew when read.
    """
    out = {}
    for name, kind in kinds.items():
        attr, entity, period = ENTITY_MODELS[name]
        df, full = getattr(models, attr), f"{prefix}{name}"
        if kind == "view":
            df.createOrReplaceTempView(full)
        elif kind == "table":
            writer = df.repartition(buckets, entity).write.mode("overwrite").bucketBy(buckets, entity).sortBy(entity, period)
            (writer.option("path", f"{location.rstrip('/')}/{full}") if location else writer).saveAsTable(full)
        else:
            raise ValueError(f"{name}: {kind!r} is neither a view nor a table")
        out[name] = full
    return out


def stored(models: Models, name: str, prefix: str = "") -> DataFrame:
    """The model from the catalog if it is there, else built."""
    full = f"{prefix}{name}"
    return models.spark.table(full) if models.spark.catalog.tableExists(full) else getattr(models, ENTITY_MODELS[name][0])


def weekly_species_summary(models: Models, prefix: str = "") -> DataFrame:
    """M12 from the stored daily panel."""
    return rollups.weekly_species_summary(stored(models, "species_day", prefix))


def monthly_species_summary(models: Models, prefix: str = "") -> DataFrame:
    """M10 from the stored counts of the grid."""
    return panel.window_metrics(stored(models, "species_month_counts", prefix), panel.MONTHLY_SPECIES)
