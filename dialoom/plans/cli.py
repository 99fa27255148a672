"""Command line: check, run, export, sources, status, plugins, init. Exit codes 0, 1 (failed), 2 (configuration)."""

from __future__ import annotations

import argparse
import json
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

from ..functions.rules import PersonaError
from . import config as configs
from . import pipeline
from .registry import GROUPS, PluginError


def session() -> SparkSession:
    return SparkSession.builder.appName("dialoom").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").getOrCreate()


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="dialoom")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("check", "run", "export", "sources", "status"):
        c = commands.add_parser(name)
        c.add_argument("--config", required=True)
        if name == "run":
            c.add_argument("--stage")
        if name == "export":
            c.add_argument("--name")
        if name == "sources":
            c.add_argument("--sample", type=int, default=3)
        if name == "status":
            c.add_argument("--watch", action="store_true")
            c.add_argument("--every", type=float, default=2.0)
    commands.add_parser("plugins")
    init = commands.add_parser("init")
    init.add_argument("--profile", required=True)
    init.add_argument("--name", required=True)
    init.add_argument("--out", required=True)
    return parser


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    say = lambda x: print(json.dumps(x, ensure_ascii=False, indent=2, default=str))
    try:
        if args.command == "plugins":
            say({g: {e.name: [e.origin, e.path] for e in r.describe()} for g, r in GROUPS.items()})
            return 0
        if args.command == "init":
            out = Path(args.out)
            if out.exists():
                print(f"{out} exists", file=sys.stderr)
                return 1
            out.write_text(GROUPS["profiles"].get(args.profile).document(args.name), encoding="utf-8")
            return 0
        config = configs.load(args.config)
        config.validate()
        spark = session()
        if args.command == "check":
            found = pipeline.check(spark, config)
            say(found)
            return int(any(found.values()))
        if args.command == "run":
            say(pipeline.run_pipeline(spark, config, args.stage))
        elif args.command == "export":
            say(pipeline.export_(pipeline.Run(spark, config), args.name))
        elif args.command == "sources":
            say(pipeline.sample_sources(spark, config, args.sample))
        else:
            say(pipeline.status(spark, config))
            while args.watch:  # until interrupted
                time.sleep(args.every)
                say(pipeline.status(spark, config))
        return 0
    except KeyboardInterrupt:
        return 0 if getattr(args, "watch", False) else 1
    except configs.ConfigError as e:
        print(f"configuration: {e}", file=sys.stderr)
        return 2
    except PersonaError as e:
        print(f"persona: {e}", file=sys.stderr)
        return 2 if args.command == "check" else 1
    except (PluginError, FileNotFoundError, OSError, ValueError) as e:
        print(f"{type(e).__name__}: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
