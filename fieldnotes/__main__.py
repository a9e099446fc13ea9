"""Command line for the three jobs, one Spark application per call.

    python -m fieldnotes ingest    --as-of YYYY-MM-DD --landing DIR [--warehouse DIR] [--places 1,6] [--taxa 10,20]
    python -m fieldnotes transform --as-of YYYY-MM-DD [--warehouse DIR] [--only m1,m2] [--epoch YYYY-MM-DD]
                                   [--lookback-years N] [--panel-lookback PANEL=N]...
                                   [--min-total-species N] [--min-total-location N]
    python -m fieldnotes forecast  --as-of YYYY-MM-DD [--warehouse DIR] [--model grouped|seasonal_naive]
    python -m fieldnotes land-testdata --sf-dir /root/testdata/sf0.01 --landing DIR

Everything not given has its production value (``Params``). Tables default to
``<spark.checkpoint.dir>/warehouse``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from fieldnotes.params import FIXTURE_PARAMS, Params


# flag -> the parameter it sets
FLAGS = {"as_of": "as_of", "epoch": "epoch", "lookback_years": "lookback_years", "panel_lookback": "panel_lookback_years",
         "min_total_species": "min_total_species", "min_total_location": "min_total_species_location",
         "places": "places", "taxa": "taxon_ids"}


def _params(args: argparse.Namespace) -> Params:
    given = {name: getattr(args, flag, None) for flag, name in FLAGS.items()}
    return Params(**{name: tuple(value) if isinstance(value, list) else value for name, value in given.items() if value is not None})


def _ints(text: str) -> tuple[int, ...]:
    return tuple(int(x) for x in text.split(","))


def _panel(text: str) -> tuple[str, int]:
    name, _, years = text.partition("=")
    return name, int(years)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="python -m fieldnotes")
    sub = parser.add_subparsers(dest="command", required=True)
    for name in ("land-testdata", "ingest", "transform", "forecast"):
        cmd = sub.add_parser(name)
        cmd.add_argument("--warehouse", default=None)
        if name != "land-testdata":
            cmd.add_argument("--as-of", type=dt.date.fromisoformat, required=True)
        cmd.add_argument("--master", default=None)
        if name in ("land-testdata", "ingest"):
            cmd.add_argument("--landing", required=True)
        if name == "ingest":
            cmd.add_argument("--places", type=_ints, default=None)
            cmd.add_argument("--taxa", type=_ints, default=None)
            cmd.add_argument("--lenient", action="store_true")
        if name == "land-testdata":
            cmd.add_argument("--sf-dir", required=True)
        if name == "transform":
            cmd.add_argument("--only", default=None)
            cmd.add_argument("--epoch", type=dt.date.fromisoformat, default=None)
            cmd.add_argument("--lookback-years", type=int, default=None)
            cmd.add_argument("--panel-lookback", type=_panel, action="append", default=None)
            cmd.add_argument("--min-total-species", type=int, default=None)
            cmd.add_argument("--min-total-location", type=int, default=None)
        if name == "forecast":
            cmd.add_argument("--model", default="order_search", choices=["order_search", "grouped", "seasonal_naive"])
    args = parser.parse_args(argv)

    from fieldnotes.plans import jobs
    from fieldnotes.session import build_session

    spark = build_session(master=args.master)
    params = FIXTURE_PARAMS if args.command == "land-testdata" else _params(args)
    if args.command == "land-testdata":
        from fieldnotes.sources import testpages
        from fieldnotes.sources.testdata import raw_observations

        raw = raw_observations(spark, args.sf_dir, params)
        for place in params.places:
            testpages.land_pages(testpages.pages_from_observations(raw, place), args.landing,
                                 load_date=params.as_of)
        result = {"landed": args.landing, "places": list(params.places)}
    elif args.command == "ingest":
        result = {"new_rows": jobs.ingest(spark, args.landing, params, args.warehouse, args.lenient)}
    elif args.command == "transform":
        only = args.only.split(",") if args.only else None
        result = {"stored": sorted(jobs.transform(spark, params, args.warehouse, only))}
    else:
        result = {"forecast_rows": jobs.forecast(spark, params, args.warehouse, args.model)}
    print(json.dumps(result))
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
