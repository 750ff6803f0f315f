"""Command line: ``python -m flightloom gold|load|intake|run``; see ``--help`` of each."""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from flightloom.operators.gold import DEFAULT_SAMPLE_RATE_HZ
from flightloom.plans.gold_job import GoldRun, run_gold, utc_now
from flightloom.plans.ingest import IntakeTables, run_intake
from flightloom.plans.refresh import load_landed, repeat_pipeline
from flightloom.plans.status_session import status_table
from flightloom.session import build_session
from flightloom.sources.listing import list_files
from flightloom.sources.tables import CatalogTable
from flightloom.streaming.intake import loads_of

log = logging.getLogger("flightloom")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="flightloom")
    commands = top.add_subparsers(dest="command", required=True)
    gold = commands.add_parser("gold", help="append the metrics of new flights")
    load = commands.add_parser("load", help="load new flight files into Silver, and Gold if given")
    intake = commands.add_parser("intake", help="process the incoming files that have no status row")
    run = commands.add_parser("run", help="intake, load and Gold whenever files have arrived")
    for command in (gold, load, run):
        command.add_argument("--silver", required=True, help="table of samples")
        command.add_argument("--gold", required=command is not load, help="table of metrics; created if missing")
    for command in (intake, run):
        command.add_argument("--incoming", required=True, help="folder of the recordings")
        command.add_argument("--attrs", required=True, help="table of decoded attributes")
        command.add_argument("--signals", required=True, help="table of decoded samples")
        command.add_argument("--prefix", required=True, help="of the names of the ids, bronze, status and lengths tables")
        command.add_argument("--others", help="folder of the signals that Silver has no column for")
    intake.add_argument("--silver", help="table of samples, whose flights are not written again")
    for command in (load, intake, run):
        command.add_argument("--landing", required=True, help="folder of the flight files")
    for command in (load, run):
        command.add_argument("--checkpoint", required=True, help="folder for the state of the stream")
        command.add_argument("--every", help='repeat on a schedule, for example "5 minutes"')
    load.add_argument("--archive", help="folder outside the landing folder to which loaded files move")
    load.add_argument("--lengths", help="table of flight lengths; Gold then waits for complete flights")
    gold.add_argument("--sample-rate", type=float, default=DEFAULT_SAMPLE_RATE_HZ)
    for command in (gold, load, intake, run):
        command.add_argument("--format", default="parquet", help="format of new tables")
    return top


def table(spark: SparkSession, args: argparse.Namespace, name: str | None) -> CatalogTable | None:
    return CatalogTable(spark, name, args.format) if name else None


def gold_command(spark: SparkSession, args: argparse.Namespace) -> GoldRun:
    silver, gold = table(spark, args, args.silver), table(spark, args, args.gold)
    run = run_gold(silver, gold, utc_now, args.sample_rate)
    if run.flights == 0:
        log.info("no new flights, %s is up to date", args.gold)
    else:
        log.info("wrote %d rows for %d new flights to %s", run.rows, run.flights, args.gold)
    return run


def load_command(spark: SparkSession, args: argparse.Namespace) -> None:
    silver, gold, lengths = (table(spark, args, n) for n in (args.silver, args.gold, args.lengths))
    load_landed(
        spark, args.landing, silver, args.checkpoint, gold, every=args.every, lengths=lengths,
        archive=args.archive,
    ).awaitTermination()


def intake_tables(spark: SparkSession, args: argparse.Namespace) -> IntakeTables:
    named = [table(spark, args, f"{args.prefix}{n}") for n in ("ids", "bronze", "status", "lengths")]
    silver = table(spark, args, args.silver)
    ids, bronze, status, lengths = named
    return IntakeTables(ids, bronze, status_table(status), args.landing, lengths, silver, silver and loads_of(silver),
                        args.others)


def intake_command(spark: SparkSession, args: argparse.Namespace) -> str:
    found = list_files(spark, args.incoming), spark.table(args.attrs), spark.table(args.signals)
    message = run_intake(*found, intake_tables(spark, args), utc_now())
    log.info(message)
    return message


def run_command(spark: SparkSession, args: argparse.Namespace) -> None:
    def recordings(arrived):
        return arrived, spark.table(args.attrs), spark.table(args.signals)

    repeat_pipeline(
        spark, args.incoming, recordings, intake_tables(spark, args), table(spark, args, args.silver),
        table(spark, args, args.gold), args.checkpoint, every=args.every,
    ).awaitTermination()


COMMANDS = {"gold": gold_command, "load": load_command, "intake": intake_command, "run": run_command}


def main(argv: Sequence[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    args = parser().parse_args(argv)
    spark = build_session(f"flightloom-{args.command}")
    try:
        COMMANDS[args.command](spark, args)
    except Exception:
        log.exception("%s failed", args.command)
        return 1
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
