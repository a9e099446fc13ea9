"""The command line runs the jobs as separate Spark applications."""

import json
import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(*args: str) -> dict:
    out = subprocess.run([sys.executable, "-m", "fieldnotes", *args], cwd=REPO, capture_output=True,
                         text=True, timeout=600, check=True)
    return json.loads(out.stdout.strip().splitlines()[-1])


def test_land_then_ingest_twice():
    base = tempfile.mkdtemp(prefix="cli-")
    landing, warehouse = os.path.join(base, "landing"), os.path.join(base, "wh")
    assert run("land-testdata", "--sf-dir", "/root/testdata/sf0.001", "--landing", landing,
               "--master", "local[2]")["places"]
    first = run("ingest", "--as-of", "2001-10-15", "--landing", landing, "--warehouse", warehouse, "--master", "local[2]")
    again = run("ingest", "--as-of", "2001-10-15", "--landing", landing, "--warehouse", warehouse, "--master", "local[2]")
    assert first["new_rows"] > 0 and again["new_rows"] == 0


def test_flags_and_production_values():
    from fieldnotes.__main__ import FLAGS, _panel, _params

    import argparse
    import datetime as dt

    none = {flag: None for flag in FLAGS}
    p = _params(argparse.Namespace(**none | {"as_of": dt.date(2024, 5, 1)}))
    assert (p.min_total_species, p.min_total_species_location, p.lookback_years, p.epoch, p.dow_since) == (
        10, 20, 10, dt.date(2008, 1, 1), dt.date(2020, 1, 1))
    p = _params(argparse.Namespace(**none | {"as_of": dt.date(2024, 5, 1), "lookback_years": 3, "panel_lookback": [_panel("daily_species_summary=1")]}))
    assert p.lookback_for("daily_species_summary") == 1 and p.lookback_for("monthly_species_summary") == 3
