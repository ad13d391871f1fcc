"""Jobs: Bronze to Silver, validation, warehouse load, training, and the chains of them."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.quality import Outcome, ValidationFailedError, validate, validate_or_raise
from tidemark.plans.forecast import Registry, train_register_deploy
from tidemark.plans.silver import to_silver
from tidemark.plans.warehouse import FACT_OF_SOURCE, Warehouse
from tidemark.session import build_session, scratch_path, scratch_root
from tidemark.sources.bronze import envelopes, read_bronze, stamp, write_bronze
from tidemark.sources.contracts import staged_valid
from tidemark.sources.registry import SOURCE_NAMES, get_source
from tidemark.sources.silver import read_silver, write_silver
from tidemark.sources.storage import delete, size_shuffles


def land_payloads(payloads: DataFrame, source: str, logical_date: str, path: str) -> None:
    """Land one pull: raw texts (page_no, payload) checked, wrapped and written for their day.

    A payload that breaks its contract stops the landing. Landing a day again replaces it. Payloads are
    parsed once; breaches and pages are counted on the way.
    """
    pages, count = staged_valid(payloads, source)
    write_bronze(envelopes(stamp(pages, source, logical_date), page_count=count), path)


def run_silver(
    spark: SparkSession, source: str, bronze_path: str, silver_path: str, multi_line: bool = True
) -> None:
    """Read every landed document of a source, build its Silver dataset and write it.

    All documents are read, so history features are complete and the dataset is replaced as a whole.
    """
    size_shuffles(spark, bronze_path)
    documents = read_bronze(spark, source, bronze_path, multi_line)
    columns = get_source(source).partition_cols
    write_silver(to_silver(documents, source), silver_path, columns, full_refresh=True)


def validate_silver(spark: SparkSession, source: str, path: str) -> Outcome:
    return validate(spark.read.parquet(path), get_source(source).suite, source)


def load_silver(
    spark: SparkSession,
    source: str,
    path: str,
    warehouse_root: str,
    gate: bool = True,
    since: date | int | None = None,
) -> Warehouse:
    """Load a Silver dataset into the warehouse; with the gate only when its suite passes.

    With `since` only Silver partitions from that day (or year) on are read and loaded; features
    are complete all the same, since Silver computed them over the whole history.
    """
    spec = get_source(source)
    size_shuffles(spark, path)
    if gate:
        validate_or_raise(spark.read.parquet(path), spec.suite, source)
    rows = read_silver(spark, source, path)
    if since is not None:
        rows = rows.where(F.col(spec.partition_cols[0]) >= F.lit(since))
    wh = Warehouse(spark, warehouse_root)
    wh.create_schema()
    wh.load(source, rows)
    return wh


def run_source(
    spark: SparkSession,
    source: str,
    bronze_path: str,
    silver_path: str,
    warehouse_root: str,
    gate: bool = True,
) -> Warehouse:
    """The whole chain of one source."""
    run_silver(spark, source, bronze_path, silver_path)
    return load_silver(spark, source, silver_path, warehouse_root, gate)


STEP = "source string, step string, status string, rows bigint, detail string"


def run_steps(
    spark: SparkSession,
    source: str,
    bronze_path: str,
    silver_path: str,
    warehouse_root: str,
    gate: bool = True,
) -> DataFrame:
    """The chain of one source as a table of its steps: silver, validate, load.

    status is ok, failed or skipped; after a failed step the rest is skipped, except that a load without
    gate follows a failed validation. rows: of the Silver dataset, expectations that fail, rows of the fact.
    """
    outcomes: list[tuple[str, str, str, int | None, str | None]] = []

    def silver() -> tuple[bool, int, str | None]:
        run_silver(spark, source, bronze_path, silver_path)
        return True, spark.read.parquet(silver_path).count(), None

    def check() -> tuple[bool, int, str | None]:
        outcome = validate_silver(spark, source, silver_path)
        return outcome.success, len(outcome.failed), ", ".join(outcome.failed) or None

    def load() -> tuple[bool, int, str | None]:
        wh = load_silver(spark, source, silver_path, warehouse_root, gate=False)
        return True, wh.table(FACT_OF_SOURCE[source].name).count(), None

    going = True
    for name, step in (("silver", silver), ("validate", check), ("load", load)):
        if not going:
            outcomes.append((source, name, "skipped", None, None))
            continue
        try:
            fine, rows, detail = step()
        except Exception as error:  # noqa: BLE001 - a step that breaks is a row, not the end of the table
            fine, rows, detail = False, None, type(error).__name__
        outcomes.append((source, name, "ok" if fine else "failed", rows, detail))
        going = fine or (name == "validate" and not gate)
    return spark.createDataFrame(outcomes, STEP)


# -- snapshot mode: single pulls straight into the warehouse


def load_snapshots(
    wh: Warehouse, pulls: Mapping[str, Callable[[], DataFrame]]
) -> DataFrame:
    """Load several sources, going on when one fails; one status row per source."""
    statuses = []
    for source, pull in pulls.items():
        try:
            path = scratch_path(wh.spark, f"snapshot-{source}")
            try:
                pull().write.parquet(path)
                silver = wh.spark.read.parquet(path)
                wh.load(source, silver)
                statuses.append((source, silver.count(), None))
            finally:
                delete(wh.spark, path)
        except Exception as error:  # noqa: BLE001 - one feed must not stop the others
            statuses.append((source, None, repr(error)))
    return wh.spark.createDataFrame(statuses, "source string, rows bigint, error string")


# -- command line


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidemark")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, *options: str, sources: bool = True) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        if sources:
            sub.add_argument("--source", required=True, choices=SOURCE_NAMES)
        for option in options:
            sub.add_argument(f"--{option}", required=True)
        return sub

    command("silver", "bronze-path", "silver-path")
    command("validate", "path")
    command("load", "path", "warehouse").add_argument(
        "--no-gate", action="store_true", help="load without validating first"
    )
    command("run", "bronze-path", "silver-path", "warehouse").add_argument(
        "--no-gate", action="store_true", help="load without validating first"
    )
    command("train", "domain", "warehouse", "registry", sources=False)
    args = parser.parse_args(argv)
    started_here = SparkSession.getActiveSession() is None
    spark = build_session(f"tidemark-{args.command}")
    try:
        if args.command == "silver":
            run_silver(spark, args.source, args.bronze_path, args.silver_path)
        elif args.command == "validate":
            outcome = validate_silver(spark, args.source, args.path)
            print(f"{outcome.asset}: {outcome.total} expectations, failed: {outcome.failed}")
            return 0 if outcome.success else 1
        elif args.command == "load":
            load_silver(spark, args.source, args.path, args.warehouse, not args.no_gate)
        elif args.command == "run":
            run_source(
                spark, args.source, args.bronze_path, args.silver_path, args.warehouse,
                not args.no_gate,
            )
        else:
            wh, registry = Warehouse(spark, args.warehouse), Registry(spark, args.registry)
            print(train_register_deploy(wh, registry, args.domain))
    except ValidationFailedError as error:
        print(error, file=sys.stderr)
        return 1
    finally:
        if started_here:
            delete(spark, scratch_root(spark))
            spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
