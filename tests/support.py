"""Values and rows that several tests use. They are here, not in a ``conftest``, because two folders have one."""

import datetime as dt

SMOKE_DIR = "/root/testdata/sf0.001"


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def raw_row(**kw):
    """A raw observation version with defaults for every RAW_OBSERVATION field."""
    base = dict(
        id=None, inaturalist_id=1, taxon_id=10, name="Taricha granulosa",
        preferred_common_name="Rough-skinned Newt", observed_date=ts("2001-03-04 00:00:00"),
        observed_month=3.0, observed_hour=0.0, observed_week=9.0, observed_year=2001.0, observed_day=4.0,
        updated_at=ts("2001-03-05 10:00:00"), species_guess=None, place_ids="{1,2}", location="45.5,-122.5",
        endemic=None, native=True, introduced=False, threatened=None, rank="species",
        wikipedia_url="https://example.org/t", out_of_range=None, identifications_most_disagree=None,
        _data_loaded_date=dt.date(2001, 10, 15),
    )
    base.update(kw)
    return base
