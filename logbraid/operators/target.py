"""Fitting rows to a target table: its columns, its key, its NOT NULL event time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logbraid.functions.names import quoted
from logbraid.sources.registry import EVENT_TS, SEQUENCE


def project_to_target(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The target's columns in its order and types; NULL where `df` has no such column."""
    present = set(df.columns)
    return df.selectExpr(
        *(
            f"CAST({quoted(f.name) if f.name in present else 'NULL'} "
            f"AS {f.dataType.simpleString()}) AS {quoted(f.name)}"
            for f in schema
        )
    )


def collapse(df: DataFrame, keys: Sequence[str], sequence: str = SEQUENCE) -> DataFrame:
    """One row per key: the highest `sequence`, and among equals the least by the other
    columns in order, NULLs last.

    Spark keeps one row per key and task before the shuffle already, so a key may have any
    number of rows. Sorting is fastest with a number or a time as the first key.
    """
    rest = [f"{quoted(c)} ASC NULLS LAST" for c in df.columns if c not in (*keys, sequence)]
    best_first = ", ".join([f"{quoted(sequence)} DESC NULLS LAST", *rest])
    rank = f"row_number() OVER (PARTITION BY {', '.join(map(quoted, keys))} ORDER BY {best_first})"
    return df.selectExpr("*", f"{rank} AS __rank").where("__rank = 1").drop("__rank")


# What a reject has beside the target's columns, and why it is one.
REJECTED_CLOCK, REASON = "rejected_clock", "reason"
NO_SESSION, NO_CLOCK = "no session", "no clock"
MALFORMED_CLOCK, DAY_OUT_OF_RANGE = "malformed clock", "day out of range"


def reject_schema(schema: T.StructType) -> T.StructType:
    """The target's columns, the clock as it was read, and the reason."""
    return T.StructType([*schema.fields]).add(REJECTED_CLOCK, T.StringType()).add(REASON, T.StringType())


def reject_reason(session: Column, clock: Column, as_read: Column) -> Column:
    """Why a row without an event time has none; `clock` is the valid one."""
    return (
        F.when(session.isNull(), NO_SESSION)
        .when(as_read.isNull(), NO_CLOCK)
        .when(clock.isNull(), MALFORMED_CLOCK)
        .otherwise(DAY_OUT_OF_RANGE)
    )


def split_valid(df: DataFrame, ts: str = EVENT_TS) -> tuple[DataFrame, DataFrame]:
    """(rows with an event time, rows without one)."""
    return df.where(F.col(ts).isNotNull()), df.where(F.col(ts).isNull())
