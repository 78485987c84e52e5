"""python -m tallyworks: one run; exit code 0 success, 1 failure, 2 some sources failed."""

from __future__ import annotations

import argparse
import os
import sys
from datetime import UTC, date, datetime

from .plans.runner import Run
from .session import build
from .sources.http import Client
from .sources.lake import Lake


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tallyworks")
    p.add_argument("--layer", choices=("raw", "curated", "reports", "all", "verify"), default="all")
    p.add_argument("--lake", required=True)
    p.add_argument("--snapshot-date", type=date.fromisoformat, default=datetime.now(UTC).date())
    p.add_argument("--as-of", type=date.fromisoformat, default=date(2026, 8, 31))
    p.add_argument("--base-url", default="http://127.0.0.1:8000")
    p.add_argument("--coach-file")
    p.add_argument("--out")
    p.add_argument("--page-size", type=int, default=500)
    p.add_argument("--full-refresh", action="store_true")
    p.add_argument("--rebuild-curated", action="store_true")
    p.add_argument("--allow-shrinking-source", action="store_true")
    p.add_argument("--from-day", type=lambda s: date.fromisoformat(s).isoformat(), help="staging reads curated days from this one on")
    p.add_argument("--full-models", action="store_true", help="staging from scratch")
    a = p.parse_args(argv)
    spark = build()
    client = Client(a.base_url, os.environ.get("API_CLIENT_ID", ""), os.environ.get("API_CLIENT_SECRET", ""))
    run = Run(spark, Lake(spark, a.lake), a.snapshot_date.isoformat(), a.as_of.isoformat(), a.full_refresh, a.allow_shrinking_source, a.rebuild_curated, a.page_size, a.from_day, a.full_models)
    return run.run(a.layer, client, a.coach_file, a.out)


if __name__ == "__main__":
    sys.exit(main())
