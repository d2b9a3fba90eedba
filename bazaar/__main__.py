"""Command line: build the models or run the data tests.

    python -m bazaar build --source DIR --target DIR [--select MODEL ...]
    python -m bazaar test  --source DIR [--output DIR] [--select MODEL ...]
    python -m bazaar query NAME --source DIR --output DIR
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="bazaar")
    sub = parser.add_subparsers(dest="command", required=True)
    b = sub.add_parser("build", help="write every intermediate model and mart as Parquet")
    b.add_argument("--source", required=True)
    b.add_argument("--target", required=True)
    t = sub.add_parser("test", help="run all declared and singular data tests")
    t.add_argument("--source", required=True)
    t.add_argument("--output", help="write the results as Parquet here (default: print failures)")
    for command in (b, t):
        command.add_argument("--select", nargs="+", metavar="MODEL", help="only these models (default: all)")
    q = sub.add_parser("query", help="run one registered query and write it as Parquet")
    q.add_argument("name")
    q.add_argument("--source", required=True)
    q.add_argument("--output", required=True)
    args = parser.parse_args(argv)

    from bazaar.operators import quality
    from bazaar.plans import Marketplace, queries
    from bazaar.plans.graph import BUILD_ORDER
    from bazaar.session import build_session

    spark = build_session()
    if args.command == "build":
        for name, path in Marketplace.load(spark, args.source).build(args.target, tuple(args.select or BUILD_ORDER)).items():
            print(f"{name}\t{path}")
        return 0
    if args.command == "test":
        models = tuple(args.select) if args.select else None
        results = quality.test_summary(Marketplace.load(spark, args.source), models)
        if args.output:
            results.write.mode("overwrite").parquet(args.output)
        failing = results.where("NOT passed").collect()  # at most one row per test
        for row in failing:
            print(*row, sep="\t")
        failed = len(failing)
        print(f"{results.count()} tests, {failed} failing")
        return 1 if failed else 0
    queries()[args.name](spark, args.source).write.mode("overwrite").parquet(args.output)
    return 0


if __name__ == "__main__":
    sys.exit(main())
