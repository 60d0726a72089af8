"""Commands: python -m ledgermill list-sources | list-profiles | import | demo | export | stats."""

from __future__ import annotations

import argparse
import sys
from datetime import datetime, timezone

from .plans.export import FORMATS
from .sources import config, registry


def session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()


def store_path(args) -> str:
    configured = str(config.resolved_path(config.load(args.config).database, args.config)) if getattr(args, "config", None) else None
    return config.setting("store", args.store, configured)


def list_sources(args) -> None:
    for s in registry.listed():
        print(f"{s.slug:16} {s.description}")


def list_profiles(args) -> None:
    found = config.load(args.config)
    for p in found.profiles:
        print(f"{p.id:24} {'enabled' if p.enabled else 'disabled':8} limit={p.max_results or found.max_results:<5} location={p.location or found.location}\n  {p.keywords}")


def import_(args) -> None:
    from .plans.store import run_import

    options = {"profile_id": args.profile, "query": args.query, "location": args.location}
    if args.profile and args.config:
        asked = config.load(args.config).resolved(args.profile, keywords=args.query, location=args.location, max_results=args.max_results)
        options |= {"query": asked["keywords"], "location": asked["location"]}
    done = run_import(session(), args.source, store_path(args), path=args.input, max_results=args.max_results, **options)
    print(f"Stored {done.processed} records in run {done.run_id}")


def demo(args) -> None:
    from .plans.store import run_demo

    done = run_demo(session(), args.store or "data/demo/listings", args.output or "data/demo/listings.json")
    print(f"Processed: {done.processed} records; exported: {done.exported} unique listings")


def export(args) -> None:
    from .plans.store import export_store

    suffix = "csv" if args.format.endswith(("csv", "csv-ru")) else args.format
    output = args.output or f"data/exports/listings_{datetime.now(timezone.utc):%Y%m%dT%H%M%SZ}.{suffix}"
    n = export_store(session(), store_path(args), output, args.format, limit=args.limit, since=args.since, complete_only=args.complete_only, include_raw=args.include_raw)
    print(f"Exported {n} unique listings to {output}")


def stats(args) -> None:
    from .plans.store import Store

    store = Store(session(), store_path(args))
    if not store.exists():
        print(f"No store yet: {store.path}")
        return
    for r in store.stats().collect():
        print(f"{r['table']:16} {r['rows']}")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="ledgermill")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name, run, about, *options):
        c = commands.add_parser(name, help=about)
        c.set_defaults(run=run)
        for flags, rest in options:
            c.add_argument(*flags, **rest)
        return c

    store, settings = (("--store",), {"help": "folder of the store"}), (("--config",), {"help": "YAML file of search profiles"})
    output = (("--output", "-o"), {"help": "output file"})
    command("list-sources", list_sources, "the sources there are")
    command("list-profiles", list_profiles, "search profiles", (("--config",), {"required": True}))
    command("demo", demo, "made-up records, imported and exported", store, output)
    command(
        "import", import_, "one run of a source into a store", (("--source",), {"default": "jsonl"}), (("--input",), {}), store, settings,
        (("--profile",), {}), (("--query",), {}), (("--location",), {}), (("--max-results",), {"type": int}),
    )
    command(
        "export", export, "the newest complete version of each listing", store, settings, output, (("--format",), {"choices": FORMATS, "default": "jsonl"}),
        (("--limit",), {"type": int}), (("--since",), {}), (("--complete-only",), {"action": "store_true"}), (("--include-raw",), {"action": "store_true"}),
    )
    command("stats", stats, "counts of a store", store, settings)
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        args.run(args)
    except (ValueError, KeyError, TypeError, OSError, RuntimeError) as error:
        print(f"Error: {error}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
