"""The command line: run, backfill, watch, registry."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Sequence

from pyspark.sql import SparkSession

from ..sources.chunks import source_from_config
from ..sources.registry import ModelRegistry
from ..streaming.arrival import ArrivalPoller, backfill
from .lifecycle import Earlier, load_config, run_lifecycle
from .triage import run_triage


def session() -> SparkSession:
    return SparkSession.builder.appName("sluice").getOrCreate()


def _run(args: argparse.Namespace) -> int:
    cfg, spark = load_config(args.config), session()
    if args.pipeline == "triage":
        result = run_triage(spark, cfg)
    else:
        chunk = None
        if args.chunk:
            found = [c for c in source_from_config(spark, cfg["source"]).chunks() if c.chunk_id == args.chunk]
            if not found:
                print(f"no chunk {args.chunk}")
                return 2
            chunk = found[0]
        result = run_lifecycle(spark, cfg, chunk)
    print(f"{result.run_id}: {result.status}")
    if result.decision:
        print(result.decision.summary())
    return 0


def _backfill(args: argparse.Namespace) -> int:
    cfg, spark = load_config(args.config), session()
    earlier = Earlier(source_from_config(spark, cfg["source"]))
    for r in backfill(earlier.source, lambda c: run_lifecycle(spark, cfg, c, earlier=earlier)):
        print(f"{r.run_id}: {r.status}")
    return 0


def _watch(args: argparse.Namespace) -> int:
    cfg, spark = load_config(args.config), session()
    source = source_from_config(spark, {**cfg["source"], "path": cfg.get("trigger", {}).get("watch", {}).get("path", cfg["source"]["path"])})
    debounce = float(cfg.get("trigger", {}).get("watch", {}).get("debounce_seconds", 5))
    poller, earlier = ArrivalPoller(source, ModelRegistry(cfg["registry"]["root"]), debounce), Earlier(source_from_config(spark, cfg["source"]))
    try:
        for r in poller.watch(lambda c: run_lifecycle(spark, cfg, c, earlier=earlier), args.rounds):
            print(f"{r.run_id}: {r.status}")
    except KeyboardInterrupt:
        pass
    return 0


def _registry(args: argparse.Namespace) -> int:
    registry = ModelRegistry(args.root)
    if args.action == "rollback":
        try:
            print(f"production: {registry.rollback().version}")
        except ValueError as e:
            print(e)
            return 2
    elif args.action == "show":
        record = registry.get(args.version or "")
        if record is None:
            print(f"no model {args.version}")
            return 2
        print(json.dumps(record.__dict__, indent=2, default=str))
    else:
        for r in registry.records():
            print(f"{r.version}\t{r.stage}\t{r.created_at}\t{r.data_version}")
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="sluice", description=__doc__)
    top.add_argument("-v", "--verbose", action="store_true")
    sub = top.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="one run of a pipeline")
    run.add_argument("pipeline", choices=("lifecycle", "triage"))
    run.add_argument("--config", required=True)
    run.add_argument("--chunk")
    run.set_defaults(do=_run)
    fill = sub.add_parser("backfill", help="all chunks in order")
    fill.add_argument("--config", required=True)
    fill.set_defaults(do=_backfill)
    watch = sub.add_parser("watch", help="chunks as they arrive")
    watch.add_argument("--config", required=True)
    watch.add_argument("--rounds", type=int)
    watch.set_defaults(do=_watch)
    registry = sub.add_parser("registry", help="models and their stages")
    registry.add_argument("action", choices=("list", "rollback", "show"))
    registry.add_argument("version", nargs="?")
    registry.add_argument("--root", default="registry")
    registry.set_defaults(do=_registry)
    return top


def main(argv: Sequence[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO if args.verbose else logging.WARNING)
    return args.do(args)


if __name__ == "__main__":
    raise SystemExit(main())
