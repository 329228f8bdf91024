"""``python -m parcela``: lists and runs the queries over a folder of Parquet tables, reports on a store, and takes an engine's steps."""

from __future__ import annotations

import argparse
import importlib
import json
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="parcela", description=__doc__)
    steps = out.add_subparsers(dest="command", required=True)
    steps.add_parser("list", help="names of all queries")
    run = steps.add_parser("run", help="a query's rows, shown or written as Parquet")
    run.add_argument("query")
    run.add_argument("--data", required=True, help="folder with the tables")
    run.add_argument("--out", help="folder to write to")
    run.add_argument("--rows", type=int, default=20, help="rows to show")
    status = steps.add_parser("status", help="how many reports a store has by state, and failed units")
    status.add_argument("--store", required=True)
    steps.add_parser("ddl", help="the statement that makes the mirror's table of reports")
    for name, what, options in STEPS:
        step = steps.add_parser(name, help=what)
        step.add_argument("--engine", required=True, help="module:function that makes the Engine from a SparkSession")
        for option in options.split():
            if option in FLAGS:
                step.add_argument(f"--{option}", action="store_true")
            else:
                step.add_argument(f"--{option}", type=int, required=option == "region" and name in ("discover", "communes"))
    return out


FLAGS = ("full", "incremental", "resume", "discover-only")
#: An engine's steps, and the options that each takes.
STEPS = (
    ("discover", "crawls a region; back from the last page, or in full", "region kind max-pages full resume"),
    ("communes", "takes a region's list of communes", "region"),
    ("process-pending", "drains pending reports", "region limit"),
    ("retry-failed", "makes failed reports pending again and drains", "region max-retries limit"),
    ("sync-mirror", "sends what changed to the mirror, or all", "limit full"),
    ("cleanup", "removes old files", ""),
    ("daily", "a day's chain", ""),
    ("backfill", "crawls regions in full and drains them", "region max-pages limit discover-only incremental resume"),
)


def take(step: str, engine, o: argparse.Namespace) -> object:
    """The figures of one of ``STEPS``."""
    from parcela.plans import daily

    if step == "discover":
        return engine.discover(o.region, (o.kind,) if o.kind else (1, 2), incremental=not o.full, resume=o.resume, most=o.max_pages)
    if step == "communes":
        return engine.sync_communes(o.region)
    if step == "process-pending":
        return engine.drain(limit=o.limit, region=o.region)
    if step == "retry-failed":
        return engine.retry(cap=o.max_retries, region=o.region, limit=o.limit)
    if step == "sync-mirror":
        return engine.mirror(limit=o.limit, full=o.full)
    if step == "cleanup":
        return engine.cleanup()
    if step == "daily":
        return daily.daily(engine.steps(), engine.settings)
    regions = engine.settings.regions if o.region is None else (o.region,)
    return daily.backfill(regions, engine.steps(), not o.discover_only, o.incremental, o.resume, o.max_pages, o.limit)


def status(spark: SparkSession, store: str) -> DataFrame:
    """The states of a store's reports and its units with errors, as (what, name, n)."""
    from pyspark.sql import functions as F

    from parcela.plans import engine
    from parcela.streaming.store import Store

    held = Store(spark, f"{store.rstrip('/')}/store", engine.tables(spark))
    reports, units = held.read("reports"), held.read("progress")
    states = reports.groupBy(F.lit("reports").alias("what"), F.col("pdf_status").alias("name")).agg(F.count("*").alias("n"))
    failed = units.where("last_error is not null").groupBy(F.lit("failed units").alias("what"), F.col("last_error").alias("name")).agg(F.count("*").alias("n"))
    return states.unionByName(failed).orderBy("what", "name")


def main(given: Sequence[str] | None = None) -> int:
    from parcela.operators import persist
    from parcela.plans import engine
    from parcela.queries import QUERIES

    args = parser().parse_args(given)
    if args.command == "list":
        print("\n".join(sorted(QUERIES)))
        return 0
    if args.command == "run" and args.query not in QUERIES:
        print(f"no query {args.query}", file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName("parcela").getOrCreate()
    if args.command in [name for name, _, _ in STEPS]:
        module, _, function = args.engine.partition(":")
        made = getattr(importlib.import_module(module), function)(spark)
        print(json.dumps(take(args.command, made, args), default=str))
        return 0
    if args.command == "run":
        found = QUERIES[args.query](spark, args.data)
        if args.out:
            found.write.parquet(args.out)
        else:
            found.show(args.rows, truncate=False)
    elif args.command == "status":
        status(spark, args.store).show(1000, truncate=False)
    else:
        schema = spark.createDataFrame([], engine.DIRECTORY).schema
        print(persist.ddl("evaluaciones", schema, "eval_id"))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
