"""Command-line entry points for ``spark-submit``.

    spark-submit ledgerlake/cli.py <job> [options]
    python -m ledgerlake.cli <job> [options]

Jobs: ``ingest``, ``index``, ``lookup``, ``users-history``, ``cards-scd2``,
``corrections``, ``warehouse``. The session comes from ``spark-submit`` (its
master and configuration); the CLI sets none. Clock values default to now.
Connection secrets for ``ingest`` are read from the environment variables
named by ``--user-env`` / ``--password-env``, never from the command line.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import os
import sys

from pyspark.sql import SparkSession


def _clock(text: str | None) -> str:
    return text or _dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerlake")
    sub = p.add_subparsers(dest="job", required=True)

    s = sub.add_parser("ingest", help="RDBMS tables -> raw parquet partitioned by ingest day")
    s.add_argument("--url", required=True)
    s.add_argument("--base", required=True, help="output base directory (raw/<table> below it)")
    s.add_argument("--driver")
    s.add_argument("--user-env", default="LEDGERLAKE_DB_USER")
    s.add_argument("--password-env", default="LEDGERLAKE_DB_PASSWORD")
    s.add_argument("--partition-column", default="id", help="numeric column to split the reads on; empty: one connection a table")
    s.add_argument("--fetch-size", type=int, default=10000)
    s.add_argument("--database", default=None, help="register the raw tables in this catalog database")
    s.add_argument("--num-partitions", type=int, default=None)
    s.add_argument("--static-overwrite", action="store_true")
    s.add_argument("--clock")

    s = sub.add_parser("index", help="build the transaction index")
    s.add_argument("--transactions", required=True)
    s.add_argument("--index", required=True)
    s.add_argument("--survivor", choices=["latest", "any"], default="latest")
    s.add_argument("--update-days", default=None,
                   help="comma-separated yyyy-mm-dd ingest days that were (re-)ingested: bring the index up to date")
    s.add_argument("--output", default=None, help="with --update-days: path of the new index version")

    s = sub.add_parser("lookup", help="look transaction ids up through the index")
    s.add_argument("--transactions", required=True)
    s.add_argument("--index", required=True)
    s.add_argument("ids", nargs="*", type=int)
    s.add_argument("--ids-parquet", default=None, help="parquet with the ids to look up (first column)")
    s.add_argument("--output", required=True, help="write found/ and missing/ here")
    s.add_argument("--prune", action="store_true")

    s = sub.add_parser("users-history", help="log UPDATE/DELETE before images, refresh the snapshot")
    s.add_argument("--current", required=True, help="path or catalog table of the current snapshot")
    s.add_argument("--incoming", required=True)
    s.add_argument("--history", required=True)
    s.add_argument("--current-base", required=True, help="directory for snapshot versions")
    s.add_argument("--current-table", default=None)
    s.add_argument("--clock")
    s.add_argument("--batch-id")
    s.add_argument("--bucket-count", type=int, default=None, help="publish the snapshot bucketed by user_id")
    s.add_argument("--order", nargs="*", default=None, help="incoming columns that decide between rows with one key")

    s = sub.add_parser("cards-scd2", help="initial load or merge of the cards type 2 dimension")
    s.add_argument("--incoming", required=True)
    s.add_argument("--table", required=True, help="catalog table that points at the published version")
    s.add_argument("--base", required=True, help="directory for versions")
    s.add_argument("--clock")
    s.add_argument("--batch-id")
    s.add_argument("--close-missing", action="store_true")
    s.add_argument("--order", nargs="*", default=None, help="incoming columns that decide between rows with one key")
    s.add_argument("--bucket-count", type=int, default=None, help="publish versions bucketed by card_id")

    s = sub.add_parser("corrections", help="replace columns of keyed rows, write a new snapshot")
    s.add_argument("--source", required=True)
    s.add_argument("--corrections", required=True, help="parquet with the key and the new values")
    s.add_argument("--output", required=True)
    s.add_argument("--key", default="id")

    s = sub.add_parser("warehouse", help="refine users, cards and the latest transaction batch")
    s.add_argument("--config", required=True, help="JSON file with RefineTargets fields")
    s.add_argument("--clock")
    return p


def _read(spark: SparkSession, source: str):
    if "/" not in source and spark.catalog.tableExists(source):
        return spark.table(source)
    return spark.read.parquet(source)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"ledgerlake-{args.job}").getOrCreate()
    out: dict = {"job": args.job}

    if args.job == "ingest":
        from ledgerlake.plans.ingest import jdbc_reader, run_raw_ingest, source_specs

        conn = {
            "user": os.environ.get(args.user_env),
            "password": os.environ.get(args.password_env),
            "driver": args.driver,
        }
        specs = source_specs(f"{args.base.rstrip('/')}/raw", args.partition_column or None, args.num_partitions, args.fetch_size)
        out["written"] = run_raw_ingest(specs, jdbc_reader(spark, args.url, **conn), _clock(args.clock),
                                        dynamic=not args.static_overwrite, database=args.database)
    elif args.job == "index":
        from ledgerlake.plans.index_job import build_index, update_index

        if args.update_days:
            days = [tuple(int(x) for x in d.split("-")) for d in args.update_days.split(",")]
            if not args.output:
                raise SystemExit("--update-days needs --output")
            out["index"] = update_index(spark, args.transactions, args.index, args.output, days)
        else:
            build_index(spark, args.transactions, args.index, survivor=args.survivor)
            out["index"] = args.index

    elif args.job == "lookup":
        from ledgerlake.plans.index_job import lookup

        if not args.ids and not args.ids_parquet:
            raise SystemExit("give ids or --ids-parquet")
        requests = spark.read.parquet(args.ids_parquet) if args.ids_parquet else args.ids
        found, missing = lookup(spark, args.index, args.transactions, requests, prune=args.prune)
        found.write.mode("overwrite").parquet(f"{args.output.rstrip('/')}/found")
        missing.write.mode("overwrite").parquet(f"{args.output.rstrip('/')}/missing")
        out["output"] = args.output
        out["index_schema"] = spark.read.parquet(args.index).schema.simpleString()
        out["found_count"] = spark.read.parquet(f"{args.output.rstrip('/')}/found").count()
    elif args.job == "users-history":
        from ledgerlake.plans.history_job import run_users_history

        run_users_history(_read(spark, args.current), _read(spark, args.incoming), args.history,
                          args.current_base, _clock(args.clock), args.batch_id, args.current_table,
                          args.bucket_count, args.order)
        out["history"] = args.history

    elif args.job == "cards-scd2":
        from ledgerlake.plans.scd2_job import run_cards_scd2

        out["version"] = run_cards_scd2(spark, _read(spark, args.incoming), args.table, args.base,
                                        _clock(args.clock), args.batch_id, args.close_missing, args.order,
                                        args.bucket_count)

    elif args.job == "corrections":
        from ledgerlake.plans.corrections_job import apply_corrections

        apply_corrections(spark, args.source, spark.read.parquet(args.corrections), args.output, args.key)
        out["output"] = args.output

    elif args.job == "warehouse":
        from ledgerlake.plans.warehouse import RefineTargets, run_warehouse

        with open(args.config) as fh:
            targets = RefineTargets(**json.load(fh))
        out["tables"] = run_warehouse(spark, targets, clock=args.clock)

    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    sys.exit(0 if main() else 1)
