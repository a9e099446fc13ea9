"""Versioned part tables, maintenance by change set, and catalog tables bucketed by entity."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from fieldnotes.operators.versions import PART, PartTable, part_of
from fieldnotes.params import Params
from fieldnotes.plans import catalog
from fieldnotes.plans.maintenance import MODELS, Maintained
from fieldnotes.plans.models import Models
from tests.support import raw_row, ts

P = Params(as_of=dt.date(2001, 10, 15), epoch=dt.date(2000, 1, 1), lookback_years=1)


def observations(ids, taxa, day="2001-03-04", **kw):
    return [raw_row(inaturalist_id=i, taxon_id=t, name=f"Genus species{t}", updated_at=ts(f"{day} 10:00:00"), observed_date=ts(f"{day} 00:00:00"),
                    location=f"45.{i % 3},-122.5", **kw) for i in ids for t in taxa]


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def check(tables, log, params):
    full = Models(tables.spark, log, params)
    for name, attr in MODELS.items():
        assert rows(tables.read(name)) == rows(getattr(full, attr)), name


def test_increments_equal_a_full_rebuild_and_touch_their_parts_only(spark, raw_df):
    tables = Maintained(spark, tempfile.mkdtemp(prefix="maintained-"), P, parts=5)
    log = raw_df(observations(range(8), range(20, 32)))
    assert all(len(parts) == 5 for parts in tables.run(log).values())
    check(tables, log, P)
    batch = raw_df(observations(range(8, 11), (21, 22), "2001-06-01") + observations([3], (21,)))  # the last one is stored
    touched = {r[0] for r in spark.createDataFrame([(21,), (22,)], "taxon_id int").select(part_of(5, "taxon_id")).collect()}
    done = tables.run(batch)
    assert all(set(parts) == touched for parts in done.values())
    log = log.unionByName(batch.where("inaturalist_id >= 8"))
    check(tables, log, P)
    # what the rebuild of a model reads: files of the touched parts
    files = tables.model("monthly_species_summary", sorted(touched)).inputFiles()
    assert files and all(any(f"/{PART}={p}/" in f for p in touched) for f in files)
    # a taxon that the log has not had, and one without a place
    new = raw_df(observations([90], (77,), "2001-07-01") + observations([91], (78,), "2001-07-01", rank="genus"))
    tables.run(new)
    log = log.unionByName(new)
    check(tables, log, P)
    assert all(parts == [] for parts in tables.run(new).values())  # nothing new: nothing is built
    later = Params(as_of=dt.date(2001, 12, 2), epoch=P.epoch, lookback_years=1)  # the grids of all taxa end elsewhere
    tables = Maintained(spark, tables.root, later, parts=5)
    assert all(len(parts) == 5 for parts in tables.run(new).values())
    check(tables, log, later)


def test_a_run_that_dies_is_repeated(spark, raw_df, monkeypatch):
    tables = Maintained(spark, tempfile.mkdtemp(prefix="maintained-"), P, parts=3, only=("species", "monthly_species_summary"))
    first, more = raw_df(observations(range(4), (1, 2, 3, 4))), raw_df(observations(range(4, 6), (2,), "2001-08-01"))
    tables.run(first)
    before = {n: rows(tables.read(n)) for n in tables.only}
    wrote = PartTable.write

    def dies(after):
        calls = []

        def write(self, df, stamps=None):
            if len(calls) == after:  # the files are there, the commit is not
                df.write.mode("overwrite").partitionBy(PART).parquet(self.folder(max(v.version for v in self.versions()) + 1))
                raise RuntimeError("lost")
            calls.append(self.path)
            return wrote(self, df, stamps)
        return write

    for after in range(3):  # at the staged rows, the first model, the second one
        monkeypatch.setattr(PartTable, "write", dies(after))
        with pytest.raises(RuntimeError):
            tables.run(more)
        monkeypatch.setattr(PartTable, "write", wrote)
        now = {n: rows(tables.read(n)) for n in tables.only}
        assert now["monthly_species_summary"] == before["monthly_species_summary"]
        assert (now["species"] == before["species"]) == (after < 2)
    tables.run(more)
    full = Models(spark, first.unionByName(more), P)
    assert rows(tables.read("species")) == rows(full.species)
    assert rows(tables.read("monthly_species_summary")) == rows(full.monthly_species_panel)


def test_part_table_keeps_the_newest_version_of_every_part(spark):
    table = PartTable(spark, tempfile.mkdtemp(prefix="parts-"))
    make = lambda *r: spark.createDataFrame(list(r), f"k int, v string, {PART} int")
    schema = make((0, "", 0)).schema
    assert table.read(schema).count() == 0 and table.vacuum() == 0
    table.write(make((1, "a", 0), (2, "b", 1)))
    table.write(make((2, "B", 1), (3, "C", 2)))
    assert sorted(map(tuple, table.read(schema).collect())) == [(1, "a"), (2, "B"), (3, "C")]
    assert sorted(map(tuple, table.read(schema, [0, 2]).collect())) == [(1, "a"), (3, "C")]
    assert table.read(schema, every_version=True).count() == 4
    table.write(make(), {0: "emptied"})
    assert sorted(map(tuple, table.read(schema).collect())) == [(2, "B"), (3, "C")]
    assert table.vacuum() == 1 and sorted(map(tuple, table.read(schema).collect())) == [(2, "B"), (3, "C")]


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_stored_models_need_no_exchange(spark, raw_df):
    m = Models(spark, raw_df(observations(range(6), range(20, 30))), P)
    base, built = tempfile.mkdtemp(prefix="catalog-"), (rows(m.weekly_species_summary), rows(m.monthly_species_panel))
    assert not spark.catalog.tableExists("built_species_day")
    names = catalog.materialise(m, {"species_day": "table", "species_month_counts": "table"}, "built_", 4, base)
    assert names == {"species_day": "built_species_day", "species_month_counts": "built_species_month_counts"}
    weekly, monthly = catalog.weekly_species_summary(m, "built_"), catalog.monthly_species_summary(m, "built_")
    assert exchanges(weekly) == exchanges(monthly) == 0
    assert (rows(weekly), rows(monthly)) == built
    views = catalog.materialise(m, {"species_day": "view"}, "seen_")
    assert spark.catalog.tableExists(views["species_day"]) and rows(catalog.weekly_species_summary(m, "seen_")) == built[0]
    assert rows(catalog.weekly_species_summary(m, "nowhere_")) == built[0]  # not in the catalog: built
    assert spark.table("built_species_day").where(F.col("taxon_id") == 20).count() > 0
    with pytest.raises(ValueError):
        catalog.materialise(m, {"species_day": "index"})
    for name in names.values():
        spark.sql(f"DROP TABLE {name}")
