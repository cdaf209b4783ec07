"""python -m stratus run|validate|status|create-config|list-queries|query."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from stratus.plans import config


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="stratus")
    verbs = parser.add_subparsers(dest="verb", required=True)
    for verb in ("run", "validate"):
        v = verbs.add_parser(verb)
        v.add_argument("--config", required=True)
        v.add_argument("--environment")
        v.add_argument("--profile")
        v.add_argument("--resume", action="store_true")
    verbs.add_parser("status").add_argument("--manifest", required=True)
    verbs.add_parser("create-config").add_argument("path")
    verbs.add_parser("list-queries")
    q = verbs.add_parser("query")
    q.add_argument("name")
    q.add_argument("--data", required=True)
    args = parser.parse_args(argv)

    if args.verb == "create-config":
        Path(args.path).write_text(json.dumps(config.default(), indent=2))
        return 0
    if args.verb == "list-queries":
        from stratus.plans.catalogue import queries

        print("\n".join(sorted(queries())))
        return 0
    if args.verb == "validate":
        p = config.load(args.config, args.environment)
        print("\n".join(p.warnings()) or "valid")
        return 0

    from stratus.session import session

    spark = session()
    if args.verb == "status":
        from stratus.operators.summary import task_status
        from stratus.plans.manifest import Manifest

        task_status(Manifest(spark, args.manifest).tasks()).show(100, truncate=False)
        return 0
    if args.verb == "query":
        from stratus.plans.catalogue import queries

        queries()[args.name](spark, args.data).show(50, truncate=False)
        return 0
    from stratus.plans.pipeline import HANDLERS
    from stratus.plans.pipeline import run as run_pipeline

    p = config.load(args.config, args.environment)
    for stage, path in run_pipeline(spark, p.profile(args.profile) if args.profile else p, HANDLERS, args.resume).items():
        print(stage, path)
    return 0


if __name__ == "__main__":
    sys.exit(main())
