"""Command line over tables: ``python -m plumbline QUERY DATA_DIR [--out PATH]``; without arguments it lists the queries."""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    from plumbline import catalog

    found = catalog.queries()
    parser = argparse.ArgumentParser(prog="plumbline")
    parser.add_argument("query", nargs="?", choices=sorted(found))
    parser.add_argument("data", nargs="?")
    parser.add_argument("--out", help="folder for parquet; without it the first rows are shown")
    args = parser.parse_args(argv)
    if not args.query or not args.data:
        print("\n".join(f"{name}: {(f.__doc__ or '').strip()}" for name, f in found.items()))
        return 0 if not args.query else 2
    result = found[args.query](SparkSession.builder.getOrCreate(), args.data)
    result.write.parquet(args.out) if args.out else result.show(20, truncate=80)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
