"""Command line for the jobs: python -m abono.cli <job> --source ... --lake ... [options]"""

from __future__ import annotations

import argparse
import datetime as dt
import os

from pyspark.sql import SparkSession

from abono import fixed
from abono.operators.checks import quality_report
from abono.plans import jobs, report
from abono.sinks import versions
from abono.sources.tables import FileSource, JdbcSource


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="abono", description=__doc__)
    p.add_argument("job", choices=["load", "daily", "rfm", "full", "report"])
    p.add_argument("--source", required=True, help="folder of Parquet tables, or a JDBC URL")
    p.add_argument("--jdbc-option", action="append", default=[], metavar="NAME=VALUE",
                   help="user, password, driver and further options of the JDBC source;"
                        " NAME=env:VARIABLE takes the value from the environment")
    p.add_argument("--partitions", type=int, default=64, help="parallel ranges of a JDBC table")
    p.add_argument("--even-ranges", action="store_true",
                   help="JDBC ranges of equal row counts instead of equal width; the database sorts its keys for it")
    p.add_argument("--raw-catalog", help="catalog with row-level writes that raw tables are merged in")
    p.add_argument("--buckets", type=int, help="buckets that merged tables are first laid out in")
    p.add_argument("--lake", required=True, help="root folder of the lake, or of the reports")
    p.add_argument("--env", choices=["local", "dev", "prod"], default="local")
    p.add_argument("--as-of", default=None, help="reference date, today by default")
    p.add_argument("--tables", nargs="+", help="raw tables to load, all by default")
    p.add_argument("--full-refresh", action="store_true", help="replace instead of merging")
    p.add_argument("--validate", action="store_true", help="check the tables after loading")
    p.add_argument("--only-validate", action="store_true", help="check without loading")
    p.add_argument("--refresh-dim", action="store_true", help="full: show the new scores at once")
    return p


def jdbc_options(given: list[str]) -> dict[str, str]:
    found = {}
    for option in given:
        name, equals, value = option.partition("=")
        if not equals:
            raise ValueError(f"--jdbc-option {name}: NAME=VALUE is needed")
        found[name] = os.environ[value[4:]] if value.startswith("env:") else value
    return found


def config(args: argparse.Namespace) -> jobs.JobConfig:
    source = (JdbcSource(args.source, jdbc_options(args.jdbc_option), args.partitions, even=args.even_ranges) if args.source.startswith("jdbc:")
              else FileSource(args.source))
    refreshed = (args.tables or list(fixed.RAW_TABLES)) if args.full_refresh else []
    return jobs.JobConfig(source, jobs.Lake(args.lake, args.env), tables=args.tables,
                          full_refresh={t: True for t in refreshed}, raw_catalog=args.raw_catalog, buckets=args.buckets)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    now = dt.datetime.now().replace(microsecond=0)
    as_of = args.as_of or now.date().isoformat()
    spark = SparkSession.builder.appName(f"abono-{args.job}").getOrCreate()
    cfg = config(args)
    if args.job == "load":
        if not args.only_validate:
            jobs.run_load(spark, cfg)
        if args.validate or args.only_validate:
            results = jobs.run_validation(spark, cfg, now)
            stored = versions.load_replace(results, cfg.lake.path(jobs.ANALYTICS, "validation"))
            for row in quality_report(stored).orderBy("check_name", "status").collect():
                print(*row)
    elif args.job == "daily":
        jobs.run_daily(spark, cfg, as_of, now)
    elif args.job == "rfm":
        jobs.run_rfm(spark, cfg, as_of)
    elif args.job == "full":
        jobs.run_full(spark, cfg, as_of, now, args.refresh_dim)
    else:
        written = report.run_report(spark, cfg.source, args.lake, as_of)
        print("report written" if written else "nothing to report")


if __name__ == "__main__":
    main()
