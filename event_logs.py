"""The given `events` table seen as logs, so that the operators have tables to run on.

Two views. `EVENTS` is a small target whose sources are the event types. `log_table` fills
any declared layout from the events of one type, so that the full 77- and 38-column jobs run
too; each text value says which log, column and event it came from. Both keep NULL and
malformed clocks in, and NULLs in every column.

Derivations are SQL text where Spark and DuckDB read it alike, so that the checks start from
the same rows; what the operators do to them is written separately on either side.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logbraid.sources.registry import (
    COUNTERS,
    EVENT_TS,
    KEY,
    NORMALIZED,
    SEQUENCE,
    SOURCE_TABLE,
    TIMES_OF_DAY,
    SourceSpec,
    TargetSpec,
)

TOLERANCE = timedelta(minutes=5)
CLOCK = "satellite_guidance_time"
EVENT_TYPES = ("signup", "error", "click", "view", "purchase")
SESSION = "concat('S', user_id % 4)"
SESSIONS = ("S0", "S1", "S2", "S3")
LANDED_NUMBERS = 4096  # sequence numbers of a block, where a query lands a log
UNNAMED_EVERY = 97  # one log row in so many has no session, where a query asks for that
USER_SESSION = "concat('U', user_id)"

_TYPES = {"value": T.DoubleType(), "user_id": T.LongType()}
_CARRIED = {
    "signup": ("value", "user_id"),
    "error": ("props", "value"),
    "click": ("user_id", "props"),
    "view": ("value",),
    "purchase": ("user_id", "props", "value"),
}
EVENTS = TargetSpec(
    "events_integration",
    (KEY, EVENT_TS, SEQUENCE, CLOCK, "user_id", "value", "props", SOURCE_TABLE),
    tuple(
        SourceSpec(name, (KEY, SEQUENCE, CLOCK, *carried), CLOCK, types=_TYPES)
        for name, carried in _CARRIED.items()
    ),
    types=_TYPES,
)

# Columns of an event as a log row, alike in Spark and DuckDB. A third of the values are NULL.
EVENT_COLUMNS = {
    SEQUENCE: "event_id",
    "user_id": "CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id END",
    "value": "CASE WHEN event_id % 3 = 1 THEN NULL ELSE value END",
    "props": "CASE WHEN event_id % 3 = 2 THEN NULL ELSE props END",
}


def clock_with_gaps(clock: str) -> str:
    """The clock as SQL, NULL or malformed now and then."""
    return (
        f"CASE WHEN event_id % 101 = 0 THEN NULL "
        f"WHEN event_id % 103 = 0 THEN '24:00:01.000' ELSE {clock} END"
    )


def lag_of(spec: SourceSpec) -> int:
    """Milliseconds a log lags behind its events, so that logs of one type differ."""
    return 200 * NORMALIZED.index(spec)


def event_type_of(spec: SourceSpec) -> str:
    return EVENT_TYPES[NORMALIZED.index(spec) % len(EVENT_TYPES)]


def log_columns(spec: SourceSpec, clock) -> dict[str, str]:
    """SQL for each column of a declared layout. `clock(milliseconds)` gives the SQL for an
    event's time of day that much later."""
    lag, hours = lag_of(spec), 8 * 3_600_000
    columns = {}
    for place, name in enumerate(spec.columns):
        if name == KEY:
            sql = SESSION
        elif name == SEQUENCE:
            sql = "event_id"
        elif name in COUNTERS:
            sql = "event_id * 7"
        elif name == spec.clock:
            sql = clock_with_gaps(clock(lag))
        elif name in TIMES_OF_DAY:
            sql = clock(lag + hours)
        else:
            sql = (
                f"CASE WHEN (event_id + {place}) % 3 = 0 THEN NULL "
                f"ELSE concat('{spec.name}.{place}.', event_id) END"
            )
        columns[name] = sql
    return columns


def spark_clock(milliseconds: int) -> str:
    later = f"ts + INTERVAL '{milliseconds / 1000:.3f}' SECOND" if milliseconds else "ts"
    return f"date_format({later}, 'HH:mm:ss.SSS')"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def event_rows(spark: SparkSession, sf_dir: str, session: str = SESSION) -> DataFrame:
    """Every event as a row of the log `source`, with its true time `ts`."""
    columns = {KEY: session, CLOCK: clock_with_gaps(spark_clock(0)), **EVENT_COLUMNS}
    return events(spark, sf_dir).selectExpr(
        "event_type AS source", "ts", *(f"{sql} AS {name}" for name, sql in columns.items())
    )


def event_tables(spark: SparkSession, sf_dir: str, session: str = SESSION) -> dict[str, DataFrame]:
    """The sources of `EVENTS`."""
    rows = event_rows(spark, sf_dir, session)
    return {
        s.name: rows.where(F.col("source") == s.name).select(*s.columns) for s in EVENTS.sources
    }


def log_table(spark: SparkSession, sf_dir: str, spec: SourceSpec) -> DataFrame:
    """A declared layout filled from the events of one type."""
    return (
        events(spark, sf_dir)
        .where(F.col("event_type") == event_type_of(spec))
        .selectExpr(*(f"{sql} AS {c}" for c, sql in log_columns(spec, spark_clock).items()))
    )


def log_tables(spark: SparkSession, sf_dir: str, target: TargetSpec) -> dict[str, DataFrame]:
    return {s.name: log_table(spark, sf_dir, s) for s in target.sources}
