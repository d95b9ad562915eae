"""Run one preset end to end.

    python -m salesfacts --preset naf_prod \\
        --table material_master=s3://.../materials --table exchange_rates=... \\
        --table order_lines=... --table delivery_lines=... --table billing_lines=... \\
        --table account_xref=... --out s3://.../sales_fact [--format parquet] [--load-ts 2026-01-01T00:00:00]

Or bind all six by ``--profile environment.json`` (``salesfacts.sources.profiles``).
A ``--table`` value without ``/`` or ``:`` is read as a metastore table name.
The session is the one the cluster provides (``getOrCreate``); on a cluster,
ship the package (``--py-files``) and submit ``salesfacts/__main__.py``.
"""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import SparkSession

from salesfacts.config import PRESETS
from salesfacts.plans.pipeline import run
from salesfacts.session import cluster_conf
from salesfacts.sources.catalog import LOGICAL_TABLES, SourceCatalog
from salesfacts.sources.profiles import bind, load_profile
from salesfacts.sources.sinks import write_sales_fact


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="salesfacts")
    ap.add_argument("--preset", required=True, choices=sorted(PRESETS), help="variant settings to run")
    ap.add_argument("--table", action="append", default=[], metavar="NAME=PATH_OR_TABLE",
                    help=f"bind a logical table ({', '.join(LOGICAL_TABLES)}); repeat for all six")
    ap.add_argument("--profile", help="environment profile (JSON) that binds all six tables; instead of --table")
    ap.add_argument("--format", default="parquet", help="format of path-bound tables")
    ap.add_argument("--out", required=True, help="output path (partitioned by year and month)")
    ap.add_argument("--load-ts", type=datetime.fromisoformat, default=None,
                    help="pin the row stamps (ISO time); default: query time")
    ap.add_argument("--input-gb", type=float, default=1024, help="GB that the job scans; sizes the shuffles")
    ap.add_argument("--cores", type=int, default=None, help="cores of the cluster; default: those the session reports")
    args = ap.parse_args(argv)

    bindings = dict(t.split("=", 1) for t in args.table)
    missing = set(LOGICAL_TABLES) - set(bindings)
    if args.profile and bindings:
        ap.error("either --profile or --table")
    if missing and not args.profile:
        ap.error(f"missing --table for {sorted(missing)}")
    # settings that must be there when the JVM starts, then those that depend on the cluster
    at_start = cluster_conf(int(args.input_gb * (1 << 30)), args.cores or 1)
    spark = SparkSession.builder.appName(f"salesfacts-{args.preset}").config(map=at_start).getOrCreate()
    cores = args.cores or spark.sparkContext.defaultParallelism
    for key, value in cluster_conf(int(args.input_gb * (1 << 30)), cores).items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    factories = {
        n: (lambda v=v: spark.table(v) if ("/" not in v and ":" not in v)
            else spark.read.format(args.format).load(v))
        for n, v in bindings.items()
    }
    catalog = bind(spark, load_profile(spark, args.profile)) if args.profile else SourceCatalog(spark, factories)
    df = run(catalog, PRESETS[args.preset], args.load_ts)
    write_sales_fact(df, args.out)


if __name__ == "__main__":
    main()
