"""Run an integration job: python -m logbraid <target> --tables <where> --into <where> [options]

Logs and target are folders, or database tables if `--database` names a connection: a JSON file
with url, driver, user, the name of the environment variable that holds the password, and, if
scans aren't to be cut by what the database tells, their split (lower, upper, parts). `--tables`
and `--into` are then prefixes of table names. Rows go to `<into><target>_staging`, which has the
columns run_id and part_id too, and from there into the keyed `<into><target>`; `--merge` names a
file with another statement for that. `<into><target>_staging_runs` (run_id, finished_at) tells
which runs are whole.

Rows without an event time go to `<target>_rejected`, with their clock as it was read and the
reason; in folders those of an earlier run of the same sessions are replaced. Without `--sortie` every session is
integrated. Submit it to a cluster with spark-submit; the master and all resources come from
there.
"""

from __future__ import annotations

import argparse
import json
import logging
import os
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from logbraid.functions.lineage import materialize, scratch
from logbraid.plans.integrate import integrate
from logbraid.sources import jdbc
from logbraid.sources.lake import read_table, replace_sessions, upsert_table
from logbraid.sources.registry import SOURCES, TARGETS, TargetSpec

log = logging.getLogger("logbraid")


def _arguments(arguments: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="logbraid")
    parser.add_argument("target", choices=TARGETS)
    parser.add_argument("--tables", required=True)
    parser.add_argument("--into", required=True)
    parser.add_argument("--sortie", action="append", dest="sessions")
    parser.add_argument("--database", type=Path)
    parser.add_argument("--merge", type=Path)
    return parser.parse_args(arguments)


def connection_from(path: Path) -> tuple[jdbc.Connection, jdbc.Split | None]:
    """A connection file's content; the password stays in the environment."""
    named = json.loads(path.read_text())
    split = named.get("split")
    return (
        jdbc.Connection(
            named["url"], named["driver"], named["user"], os.environ[named["password_variable"]]
        ),
        jdbc.Split(**split) if split else None,
    )


Reader = Callable[[str], DataFrame]
Writer = Callable[[DataFrame, DataFrame], None]


def _folders(
    spark: SparkSession, options: argparse.Namespace, target: TargetSpec
) -> tuple[Reader, Writer]:
    def read(name: str) -> DataFrame:
        return read_table(spark, f"{options.tables}/{name}", SOURCES[name].schema, options.sessions)

    def write(rows: DataFrame, rejected: DataFrame) -> None:
        into = f"{options.into}/{target.name}"
        upsert_table(spark, into, rows, target, options.sessions, is_table=True)
        replace_sessions(spark, f"{into}_rejected", rejected, options.sessions)

    return read, write


def _database(
    spark: SparkSession, options: argparse.Namespace, target: TargetSpec
) -> tuple[Reader, Writer]:
    connection, split = connection_from(options.database)

    def read(name: str) -> DataFrame:
        table = f"{options.tables}{name}"
        return jdbc.read_table(spark, connection, table, options.sessions, split)

    def write(rows: DataFrame, rejected: DataFrame) -> None:
        into = f"{options.into}{target.name}"
        staging = f"{into}_staging"
        merge = jdbc.merge_statement(target, into, staging, f"{staging}_runs")
        merge = options.merge.read_text() if options.merge else merge
        jdbc.write_staged(rows, connection, staging, merge)
        jdbc.write_table(rejected, connection, f"{into}_rejected")

    return read, write


def main(arguments: Sequence[str] | None = None) -> None:
    options = _arguments(arguments)
    spark = SparkSession.builder.appName(options.target).getOrCreate()
    target = TARGETS[options.target]
    read, write = (_database if options.database else _folders)(spark, options, target)
    with scratch(spark):
        result = integrate(target, read, options.sessions)
        rows = materialize(result.rows, "rows")
        rejected = materialize(result.rejected, "rejected")
        write(rows, rejected)
        log.info(
            "%s: %d rows integrated into %s, %d rejected",
            target.name, rows.count(), options.into, rejected.count(),
        )


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    main()
