"""python -m corpusloom STAGE: the stages over folders, from the command line."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from corpusloom.config import load
from corpusloom.plans.pipeline import Runner


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="corpusloom")
    parser.add_argument("--config", help="settings as YAML")
    sub = parser.add_subparsers(dest="stage", required=True)
    for name in ("extract", "clean", "profile", "build"):
        one = sub.add_parser(name)
        one.add_argument("--in", dest="source", required=True)
        one.add_argument("--out", required=True)
    both = sub.add_parser("integrate")
    for name in ("base", "new", "out"):
        both.add_argument(f"--{name}", required=True)
    args = parser.parse_args(argv)
    runner = Runner(SparkSession.builder.appName(f"corpusloom {args.stage}").getOrCreate(), load(args.config))
    if args.stage == "integrate":
        runner.integrate(args.base, args.new, args.out)
    else:
        getattr(runner, args.stage)(args.source, args.out)
    print(runner.report())
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
