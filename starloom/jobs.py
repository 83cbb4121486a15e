"""Command line for spark-submit.

    listening   raw log and song JSON to the star schema
    hourly      raw log and song JSON that arrived since the last run, all tables in one checked commit per step
    arrivals    raw arrival records and lookup CSV files to the fact and its dimensions, in one commit
    check       quality checks on the tables of a folder; exit code 1 when one fails
    export      arrivals tables as JSON lines
    publish     arrivals statistics and dimensions into keyed tables, later rows replacing earlier ones
    train       overstay model from the feature table
    score       overstay probabilities of the feature table's rows
"""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from starloom.operators import quality
from starloom.plans import arrivals, listening, listening_hourly, overstay_model, tables
from starloom.session import build_session, size_shuffles
from starloom.sources.manifest import open_table, table_folder
from starloom.sources.readers import read_union
from starloom.sources.snapshots import upsert
from starloom.sources.writers import export_json, write_parquet

# Raw arrival fields by type; the export of a year's files may hold further ones.
RAW_NUMBERS = "admnum i94yr i94mon i94cit i94res arrdate depdate i94mode i94visa i94bir cicid".split()
RAW_TEXTS = "i94port i94addr dtaddto matflag gender visatype entdepa entdepd entdepu".split()
RAW_SCHEMA = ", ".join([*(f"{c} double" for c in RAW_NUMBERS), *(f"{c} string" for c in RAW_TEXTS)])

# The keys the published tables are looked up by.
PUBLISHED_KEYS = {
    "immigration_stats": ["country_code_iso_2", "year", "month", "day"],
    "country": ["country_code"],
    "state": ["state_code"],
    "visa_type": ["visa_type"],
    "gdp": ["country_code"],
}


def run_listening(spark: SparkSession, args: argparse.Namespace) -> None:
    listening.load(size_shuffles(spark, args.log), args.log, args.songs, args.out, args.match)


def run_hourly(spark: SparkSession, args: argparse.Namespace) -> None:
    listening_hourly.run(size_shuffles(spark, args.log), args.log, args.songs, args.out, args.progress, args.match)


def run_arrivals(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = read_union(size_shuffles(spark, args.raw), [args.raw], RAW_SCHEMA, args.format)
    arrivals.run(spark, raw, arrivals.read_dimensions(spark, args.lookups), args.out, tie=["cicid"], writer=args.writer, batch=args.batch)


def run_check(spark: SparkSession, args: argparse.Namespace) -> None:
    schemas, checks = {
        "listening": (tables.LISTENING_TABLES, tables.listening_checks),
        "arrivals": (tables.ARRIVALS_TABLES, tables.arrivals_checks),
    }[args.domain]
    quality.enforce(quality.run_checks(checks(tables.read_tables(size_shuffles(spark, args.tables), args.tables, schemas))))


def run_export(spark: SparkSession, args: argparse.Namespace) -> None:
    export_json(tables.read_tables(size_shuffles(spark, args.tables), args.tables, tables.ARRIVALS_TABLES), args.out)


def run_publish(spark: SparkSession, args: argparse.Namespace) -> None:
    for name, df in tables.read_tables(size_shuffles(spark, args.tables), args.tables, PUBLISHED_KEYS).items():
        upsert(df, f"{args.out}/{name}", PUBLISHED_KEYS[name], [], arrival_wins=True)


def run_train(spark: SparkSession, args: argparse.Namespace) -> None:
    features = open_table(size_shuffles(spark, table_folder(spark, args.features)), args.features)
    model, auc = overstay_model.tune(features, folds=args.folds)
    logging.getLogger(__name__).info("area under ROC %.4f", auc)
    overstay_model.save(model, args.model)


def run_score(spark: SparkSession, args: argparse.Namespace) -> None:
    features = open_table(size_shuffles(spark, table_folder(spark, args.features)), args.features)
    write_parquet(overstay_model.score(features, overstay_model.load(args.model)), args.out)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="starloom", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, run, *paths: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        sub.set_defaults(run=run)
        for path in paths:
            sub.add_argument(f"--{path}", required=True)
        sub.add_argument("--scratch", help="folder shared by all executors, for checkpoints and intermediate tables")
        return sub

    command("listening", run_listening, "log", "songs", "out").add_argument(
        "--match", choices=["lookup", "inner", "left"], default="lookup"
    )
    command("hourly", run_hourly, "log", "songs", "out", "progress").add_argument(
        "--match", choices=["lookup", "inner", "left"], default="lookup"
    )
    arrivals_command = command("arrivals", run_arrivals, "raw", "lookups", "out")
    arrivals_command.add_argument("--format", choices=["parquet", "csv", "json"], default="parquet")
    arrivals_command.add_argument("--writer", default="", help="who loads; with --batch, a run that is committed is not done again")
    arrivals_command.add_argument("--batch", type=int, help="number of this run among the writer's, rising")
    command("check", run_check, "tables").add_argument("--domain", choices=["listening", "arrivals"], required=True)
    command("export", run_export, "tables", "out")
    command("publish", run_publish, "tables", "out")
    command("train", run_train, "features", "model").add_argument("--folds", type=int, default=5)
    command("score", run_score, "features", "model", "out")
    return top


def main(argv: list[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    args = parser().parse_args(argv)
    try:
        shared = {"spark_checkpoint_dir": args.scratch} if args.scratch else {}
        args.run(build_session(f"starloom-{args.command}", **shared), args)
    except quality.QualityError as error:
        logging.getLogger(__name__).error("checks failed: %s", error)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
