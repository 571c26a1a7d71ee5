"""Run a catalogue query or a text job from the command line.

    python -m linewise list
    python -m linewise query q01_boundary_group_totals /root/testdata/sf0.01 [--explain] [--show 20] [--out PATH]
    python -m linewise job top_records_total path/to/input.txt

Under ``spark-submit`` the submitted session configuration is used; run
directly, a local session is created.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from linewise.plans import text_jobs
from linewise.plans.catalogue import QUERIES

JOBS = ("record_totals", "largest_record_total", "top_records_total", "code_pair_scores", "code_pair_totals",
        "half_common_total", "batch_common_total", "interval_pair_flags", "interval_pair_counts", "layout_block")


def main() -> None:
    parser = argparse.ArgumentParser(prog="linewise")
    sub = parser.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    q = sub.add_parser("query")
    q.add_argument("name", choices=sorted(QUERIES))
    q.add_argument("tables")
    j = sub.add_parser("job")
    j.add_argument("name", choices=JOBS)
    j.add_argument("path")
    for p in (q, j):
        p.add_argument("--explain", action="store_true")
        p.add_argument("--show", type=int, default=20)
        p.add_argument("--out", help="write the result as parquet here instead of showing it")
    args = parser.parse_args()

    if args.cmd == "list":
        print("\n".join(["queries:", *sorted(QUERIES), "jobs:", *JOBS]))
        return
    active = SparkSession.getActiveSession()
    if active is None:
        from linewise.session import local_session
        active = local_session()
    df = QUERIES[args.name](active, args.tables) if args.cmd == "query" else getattr(text_jobs, args.name)(active, args.path)
    if args.explain:
        df.explain("formatted")
    if args.out:
        df.write.mode("errorifexists").parquet(args.out)
    else:
        df.show(args.show, truncate=False)


if __name__ == "__main__":
    main()
