"""From a raw log to its normalized form: filter, project, rename, check the clock."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logbraid.functions.names import quoted
from logbraid.functions.times import DEFAULT_BASE_DATE, valid_clock
from logbraid.operators.clock import unwrap_clock
from logbraid.sources.registry import EVENT_TS, KEY, SEQUENCE, SOURCE_TABLE, SourceSpec


def of_sessions(df: DataFrame, sessions: Iterable[str] | None = None, key: str = KEY) -> DataFrame:
    """Rows of the named sessions, or of every session. Rows without a session never count."""
    if sessions is None:
        return df.where(F.col(key).isNotNull())
    return df.where(F.col(key).isin(*sessions))


def rename_columns(df: DataFrame, spec: SourceSpec) -> DataFrame:
    return df.selectExpr(
        *(f"{quoted(c)} AS {quoted(spec.renames.get(c, c))}" for c in spec.columns)
    )


def normalize(
    df: DataFrame,
    spec: SourceSpec,
    sessions: Iterable[str] | None = None,
    as_read: str | None = None,
) -> DataFrame:
    """Declared columns under their common names, with malformed clocks made NULL. The clock as it
    was read can be kept under the name `as_read`."""
    return _with_valid_clock(rename_columns(of_sessions(df, sessions), spec), spec, as_read)


def without_session(df: DataFrame, spec: SourceSpec, as_read: str | None = None) -> DataFrame:
    """What `normalize` leaves out in every case: rows of no session, in the same form."""
    return _with_valid_clock(rename_columns(df.where(F.col(KEY).isNull()), spec), spec, as_read)


def _with_valid_clock(df: DataFrame, spec: SourceSpec, as_read: str | None) -> DataFrame:
    if as_read:
        df = df.withColumn(as_read, F.col(spec.clock))
    return df.withColumn(spec.clock, valid_clock(F.col(spec.clock)))


def processed(
    df: DataFrame,
    spec: SourceSpec,
    sessions: Iterable[str] | None = None,
    base_date: str = DEFAULT_BASE_DATE,
) -> DataFrame:
    """The normalized log with `event_ts` and the name of the log as `source_table`."""
    placed = unwrap_clock(
        normalize(df, spec, sessions), [KEY], SEQUENCE, spec.clock, base_date, into=EVENT_TS
    )
    return placed.withColumn(SOURCE_TABLE, F.lit(spec.name))
