"""Command line: ``python -m clinark <command> ...``, or on a cluster
``spark-submit --py-files clinark.zip clinark/__main__.py <command> ...`` (the package
zipped, the module file as the application).

Commands
  ingest  --landing DIR --routed DIR --checkpoint DIR [--continuous SECONDS] [--archive DIR]
          route landed NDJSON lines by resource type (exactly once per checkpoint)
  job     --raw DIR --out DIR [--layout routed|directory] [--patient-key plain|hashed]
          [--publish] [--no-cluster] [--jdbc-url URL --jdbc-user U --jdbc-password-env VAR --jdbc-connections N]
          raw → clean → gold (+ optional JDBC loads); prints the load audit. --publish writes
          a version below --out and makes it current when it is whole
  register --clean DIR [--db NAME] [--no-cluster]
          clean tables as external Parquet tables of a catalog database
  land    --sf-dir DIR --landing DIR
          write FHIR NDJSON derived from the star-schema test tables
The session comes from spark-submit (cluster settings are not overridden here).
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

from clinark.sources.jdbc import CONNECTIONS


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="clinark")
    sub = p.add_subparsers(dest="cmd", required=True)
    i = sub.add_parser("ingest")
    i.add_argument("--landing", required=True)
    i.add_argument("--routed", required=True)
    i.add_argument("--checkpoint", required=True)
    i.add_argument("--max-files-per-trigger", type=int, default=None)
    i.add_argument("--archive", default=None,
                   help="move picked-up files here once their batch is committed")
    i.add_argument("--continuous", type=int, default=None,
                   help="run every N seconds instead of once")
    j = sub.add_parser("job")
    j.add_argument("--raw", required=True)
    j.add_argument("--out", required=True)
    j.add_argument("--layout", choices=["routed", "directory"], default="routed")
    j.add_argument("--patient-key", choices=["plain", "hashed"], default="hashed")
    j.add_argument("--top-n", type=int, default=None)
    j.add_argument("--publish", action="store_true",
                   help="write a new version of the tiers and publish it at the end")
    j.add_argument("--no-cluster", action="store_true",
                   help="write the clean tables unclustered (no range sort by patient)")
    j.add_argument("--jdbc-url", default=None)
    j.add_argument("--jdbc-user", default=None)
    j.add_argument("--jdbc-password-env", default=None,
                   help="name of the environment variable holding the password")
    j.add_argument("--jdbc-driver", default=None)
    j.add_argument("--jdbc-connections", type=int, default=CONNECTIONS,
                   help="connections a table load opens at most")
    r = sub.add_parser("register")
    r.add_argument("--clean", required=True, help="the job's clean folder (<out>/clean)")
    r.add_argument("--db", default="medical")
    r.add_argument("--no-cluster", action="store_true",
                   help="the clean tables were written without --cluster")
    ld = sub.add_parser("land")
    ld.add_argument("--sf-dir", required=True)
    ld.add_argument("--landing", required=True)
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"clinark-{args.cmd}").getOrCreate()
    if args.cmd == "ingest":
        from clinark.streaming.ingest import run_ingest, start_ingest
        if args.continuous:
            q = start_ingest(spark, args.landing, args.routed, args.checkpoint,
                             available_now=False, processing_time=f"{args.continuous} seconds",
                             max_files_per_trigger=args.max_files_per_trigger,
                             archive_dir=args.archive)
            q.awaitTermination()
        else:
            n = run_ingest(spark, args.landing, args.routed, args.checkpoint,
                           max_files_per_trigger=args.max_files_per_trigger,
                           archive_dir=args.archive)
            print(f"routed {n} lines")
    elif args.cmd == "job":
        from clinark.plans.jobs import JdbcTarget, publish_pipeline, run_pipeline
        jdbc = None
        if args.jdbc_url:
            props = {}
            if args.jdbc_user:
                props["user"] = args.jdbc_user
            if args.jdbc_password_env:
                props["password"] = os.environ[args.jdbc_password_env]
            if args.jdbc_driver:
                props["driver"] = args.jdbc_driver
            jdbc = JdbcTarget(args.jdbc_url, props, num_partitions=args.jdbc_connections)
        job = publish_pipeline if args.publish else run_pipeline
        audit = job(spark, args.raw, args.out, layout=args.layout, patient_key=args.patient_key,
                    jdbc=jdbc, top_n=args.top_n, cluster=not args.no_cluster)
        for row in audit.collect():  # the audit is one row per table
            print(f"'{row['table']}': {row['rows']} rows")
    elif args.cmd == "register":
        from clinark.sources.catalog import register_clean
        for name in register_clean(spark, args.clean, args.db, clustered=not args.no_cluster):
            print(f"registered {name}")
    elif args.cmd == "land":
        from clinark.sources.landing import land_mixed
        land_mixed(spark, args.sf_dir, args.landing)
    return 0


if __name__ == "__main__":
    sys.exit(main())
