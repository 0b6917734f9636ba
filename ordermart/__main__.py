"""``python -m ordermart STEP SOURCE_ROOT WAREHOUSE``, also for spark-submit."""

from __future__ import annotations

import argparse

from ordermart.plans import job
from ordermart.session import build_session

STEPS = {"daily": job.run_daily, "load": job.run_load, "mart": job.run_mart, "forecast": job.run_forecast}


def settings_from(arguments: list[str] | None = None) -> tuple[str, job.Settings]:
    parser = argparse.ArgumentParser(prog="ordermart")
    parser.add_argument("step", choices=sorted(STEPS))
    parser.add_argument("source_root")
    parser.add_argument("warehouse")
    parser.add_argument("--format", dest="source_format", choices=["csv", "parquet"], default="csv")
    parser.add_argument("--multi-line", action="store_true", help="CSV values may contain line breaks")
    parser.add_argument("--calendar-start", default=job.Settings.calendar_start)
    parser.add_argument("--calendar-end", default=job.Settings.calendar_end)
    parser.add_argument("--as-of", default=job.Settings.as_of, help="reference day of tenure and experience")
    parser.add_argument("--horizon", type=int, default=job.Settings.horizon, help="days to forecast")
    parser.add_argument("--quarantine", action="store_true", help="set rows apart that do not fit, instead of failing")
    parser.add_argument("--mart", choices=["refresh", "upsert"], default=job.Settings.mart)
    options = vars(parser.parse_args(arguments))
    return options.pop("step"), job.Settings(**options)


def main(arguments: list[str] | None = None) -> None:
    step, settings = settings_from(arguments)
    STEPS[step](build_session(), settings)


if __name__ == "__main__":
    main()
