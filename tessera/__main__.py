"""Run a registered query by name.

    python -m tessera list
    python -m tessera run profile_gated --sf-dir /root/testdata/sf0.01 [--show 10] [--csv OUT_DIR]

``--show`` prints the first rows in the query's own order (bounded); ``--csv``
writes the whole result as a CSV folder (one part per partition). The session
comes from ``SparkSession.builder.getOrCreate()`` so cluster settings apply.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans.catalog import ORACLE, QUERIES
from .sources.tables import write_csv


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="python -m tessera")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="registered queries")
    run = sub.add_parser("run", help="run one query")
    run.add_argument("name", choices=sorted(QUERIES))
    run.add_argument("--sf-dir", required=True)
    run.add_argument("--show", type=int, default=10)
    run.add_argument("--csv", default=None)
    args = ap.parse_args(argv)
    if args.cmd == "list":
        for name in QUERIES:
            print(name, "(oracle)" if name in ORACLE else "")
        return
    spark = SparkSession.builder.getOrCreate()
    df = QUERIES[args.name](spark, args.sf_dir)
    if args.csv:
        print(write_csv(df, args.csv))
    if args.show:
        df.show(args.show, truncate=False)


if __name__ == "__main__":
    main()
