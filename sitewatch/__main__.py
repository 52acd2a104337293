"""``python -m sitewatch {create,discover,observe,status,export}``, also for spark-submit."""

import argparse
import json
from datetime import datetime, timezone

from sitewatch.plans.discover import discover
from sitewatch.plans.observe import observe
from sitewatch.plans.status import register_views, run_checks
from sitewatch.schemas import REGISTRY
from sitewatch.session import build_session
from sitewatch.sources.snapshots import create_table, read_snapshot
from sitewatch.sources.tables import create_history, read_fetches, read_history, write_csv


def _run_time(text: str) -> datetime:
    moment = datetime.fromisoformat(text)
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


# The paths each run needs besides the registry.
_RUNS = {
    "create": ["history"],
    "discover": ["fetches"],
    "observe": ["fetches", "history"],
    "status": ["history", "out"],
    "export": ["history", "out"],
}
_HELP = {
    "fetches": "Parquet table of stored pages: url, html, fetched_at",
    "history": "Parquet table of observations",
    "out": "folder to write the current status, or the exported tables, to",
}


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="sitewatch")
    runs = parser.add_subparsers(dest="run", required=True)
    for name, paths in _RUNS.items():
        run = runs.add_parser(name)
        run.add_argument("--registry", required=True, help="root of the page registry")
        for path in paths:
            run.add_argument(f"--{path}", required=True, help=_HELP[path])
        if "fetches" in paths:
            run.add_argument("--run-ts", type=_run_time, default=datetime.now(timezone.utc))
        if name == "discover":
            run.add_argument("--start-url", required=True)
            run.add_argument(
                "--without-outlink",
                action="store_true",
                help="also report pages that show no in-site link of their own",
            )
    return parser.parse_args()


def main() -> None:
    args = _arguments()
    spark = build_session()
    if args.run == "create":
        create_table(spark, args.registry, REGISTRY)
        create_history(spark, args.history)
        result = {"created": [args.registry, args.history]}
    elif args.run == "discover":
        fetches = read_fetches(spark, args.fetches)
        result = discover(
            spark, fetches, args.registry, args.start_url, args.run_ts, not args.without_outlink
        )
    elif args.run == "observe":
        fetches = read_fetches(spark, args.fetches)
        result = observe(spark, args.registry, fetches, args.history, args.run_ts)
    elif args.run == "export":
        write_csv(read_snapshot(spark, args.registry, REGISTRY), f"{args.out}/pages")
        write_csv(read_history(spark, args.history), f"{args.out}/scrape_history")
        result = {"exported": [f"{args.out}/pages", f"{args.out}/scrape_history"]}
    else:
        pages = read_snapshot(spark, args.registry, REGISTRY)
        views = register_views(pages, read_history(spark, args.history))
        views["vw_page_current_status"].write.parquet(args.out)
        # One row per declared check.
        result = {"checks": [row.asDict() for row in run_checks(spark).collect()]}
    print(json.dumps(result))
    if any(check["failures"] for check in result.get("checks", [])):
        raise SystemExit(1)


if __name__ == "__main__":
    main()
