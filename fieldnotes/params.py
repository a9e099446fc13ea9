"""Run parameters.

Everything the reference reads from the wall clock (``CURRENT_DATE``,
``now()``) or from the deployment target (dev/prod lookbacks) is an explicit
value here, so every job is a pure function of its inputs.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # "today": cut-off for panels, lookback anchor, load and forecast stamp
    as_of: dt.date
    # first day kept by staging and first day of the day spine
    epoch: dt.date = dt.date(2008, 1, 1)
    # the day spine runs this many days past as_of
    horizon_days: int = 30
    # calendar years of history kept by the panels, and by single panels that differ (panel, years)
    lookback_years: int = 10
    panel_lookback_years: tuple[tuple[str, int], ...] = ()
    # calendar years of history fed to the forecasters
    prep_lookback_years: int = 3
    # series must have a total strictly greater than this to be forecast
    min_total_species: int = 10
    min_total_species_location: int = 20
    # lower bound of the day-of-week analysis
    dow_since: dt.date = dt.date(2020, 1, 1)
    # forecasting: horizon (steps), season length, interval level (%)
    h: int = 4
    season: int = 12
    level: int = 90
    # taxon ranks that count as species-level facts
    species_ranks: tuple[str, ...] = ("species", "subspecies")
    # what the ingest job asks the source for: places, taxa (none: all), captive observations or not
    places: tuple[int, ...] = (1, 6)
    taxon_ids: tuple[int, ...] = ()
    captive: bool = False
    # incremental scenario: rows updated before this day form the first load
    first_load_before: dt.date = dt.date(2000, 1, 1)
    # the "updated since" request predicate of a source pull
    source_updated_since: dt.date = dt.date(2001, 1, 1)
    # sort final model outputs the way the reference does (a range shuffle)
    order_output: bool = True

    @property
    def spine_end(self) -> dt.date:
        return self.as_of + dt.timedelta(days=self.horizon_days)

    @property
    def spine_days(self) -> int:
        """Rows of the day spine; a bound that depends on parameters only."""
        return (self.spine_end - self.epoch).days + 1

    def lookback_for(self, panel: str) -> int:
        """Calendar years of history of one panel."""
        return dict(self.panel_lookback_years).get(panel, self.lookback_years)

    def lookback_start(self, panel: str) -> dt.date:
        """First day of the first calendar year that ``panel`` keeps."""
        return dt.date(self.as_of.year - self.lookback_for(panel), 1, 1)


# Dates of the test-data mapping (FIXTURES.md section 5); everything else has its production value.
FIXTURE_PARAMS = Params(as_of=dt.date(2001, 10, 15), epoch=dt.date(1995, 1, 1), dow_since=dt.date(2000, 1, 1))

__all__ = ["Params", "FIXTURE_PARAMS"]
