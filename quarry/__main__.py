"""Command line: run a pipeline config document as one Spark job.

    python -m quarry run conf.json [--folder mappings/] [--warehouse warehouse/]
        [--split-bytes N] [--master local[8]] [--conf key=value ...]

Entries without mapping and SQL of their own have them in ``--folder``, by the name
of their destination; ``--warehouse`` is where destinations given by name go.  Each entry of ``{"conf": [...]}`` is planned and published in order; a
short summary (rows per destination) is printed as JSON lines.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from .plans.pipeline import run_batch
from .session import build_session


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="python -m quarry")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="run every entry of a config document")
    run.add_argument("document", help="JSON/YAML file with {'conf': [...]}")
    run.add_argument("--folder", default=None, help="folder of <destination>.json and <destination>.sql files")
    run.add_argument("--warehouse", default=None, help="folder of destinations given by name")
    run.add_argument("--split-bytes", type=int, default=None, help="pack files into read splits of this size")
    run.add_argument("--master", default=None)
    run.add_argument("--conf", action="append", default=[], help="extra Spark setting key=value")
    args = parser.parse_args(argv)

    extra = dict(item.split("=", 1) for item in args.conf)
    spark = build_session(args.master, extra=extra, split_bytes=args.split_bytes)
    try:
        for destination, table in run_batch(spark, args.document, args.folder, args.warehouse).items():
            n = table.agg(F.count(F.lit(1)).alias("n")).first()["n"]
            print(json.dumps({"destination": destination, "rows": n}))
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
