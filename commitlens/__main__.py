"""Command line: list the registered questions, or run one over a folder of tables.

    python -m commitlens list
    python -m commitlens run commit_ext_freq --sf /root/testdata/sf0.01 --show 20
    python -m commitlens run commit_days_since_prev --sf /data/sf100 --out /data/out/w1 --format parquet
    python -m commitlens sql commit_ext_freq          # the DuckDB oracle SQL of a question

``run`` uses the active cluster session when there is one (``--master`` only for local runs) and writes with
Spark; nothing is collected except the ``--show`` rows.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="commitlens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list registered query keys")
    sq = sub.add_parser("sql", help="print the oracle SQL of a query")
    sq.add_argument("key")
    run = sub.add_parser("run", help="run a query")
    run.add_argument("key")
    run.add_argument("--sf", required=True, help="folder with the <table>.parquet files")
    run.add_argument("--show", type=int, help="rows to print (default 20, or none with --out)")
    run.add_argument("--out", help="write the full result here")
    run.add_argument("--format", default="parquet", choices=["parquet", "csv", "json"])
    run.add_argument("--overwrite", action="store_true", help="replace an existing --out folder")
    run.add_argument("--master", help="e.g. local[8]; omit on a cluster")
    run.add_argument("--explain", action="store_true", help="print the formatted physical plan")
    args = ap.parse_args(argv)

    from commitlens.plans.bindings import ORACLE, QUERIES
    if args.cmd == "list":
        for k in sorted(QUERIES):
            print(k)
        return 0
    if args.cmd == "sql":
        print(ORACLE.get(args.key, f"-- no oracle SQL for {args.key}"))
        return 0
    if args.key not in QUERIES:
        print(f"unknown query {args.key!r}; see `python -m commitlens list`", file=sys.stderr)
        return 2
    from commitlens.session import build_session, clear_scratch
    spark = build_session(args.master)
    try:
        df = QUERIES[args.key](spark, args.sf)
        if args.explain:
            df.explain("formatted")
        if args.out:
            df.write.mode("overwrite" if args.overwrite else "errorifexists").format(args.format).save(args.out)
            df = spark.read.format(args.format).schema(df.schema).load(args.out)
        show = args.show if args.show is not None else (0 if args.out else 20)
        if show:
            df.show(show, truncate=False)
    finally:
        clear_scratch(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
