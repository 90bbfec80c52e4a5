"""The integration job: many logs of many sessions into one target table."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import timedelta
from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logbraid.functions.lineage import materialize
from logbraid.functions.times import DEFAULT_BASE_DATE, clock_digits, from_micros
from logbraid.operators.fuse import fuse_chosen, latest_partners, pack, unpack
from logbraid.operators.normalize import normalize, without_session
from logbraid.operators.target import (
    REASON,
    REJECTED_CLOCK,
    project_to_target,
    reject_reason,
    reject_schema,
)
from logbraid.plans.placement import EVENT_US, Placement
from logbraid.sources.registry import EVENT_TS, KEY, SEQUENCE, SOURCE_TABLE, SourceSpec, TargetSpec

# Fixed value: how far apart in time rows may be to describe one moment.
TOLERANCE = timedelta(seconds=1)


class Integration:
    """`rows` in the target's schema, one per key. `rejected` are spine rows without an event time
    and, if no sessions were named, rows of any log without a session; beside the target's columns
    they have their clock as it was read and the reason, so that they can be repaired.

    Each is planned on first use; both share one pass over keys and clocks.
    """

    def __init__(self, build_rows: Callable[[], DataFrame], build_rejected: Callable[[], DataFrame]):
        self._build_rows, self._build_rejected = build_rows, build_rejected

    @cached_property
    def rows(self) -> DataFrame:
        return self._build_rows()

    @cached_property
    def rejected(self) -> DataFrame:
        return self._build_rejected()


def integrate(
    target: TargetSpec,
    reader: Callable[[str], DataFrame] | Mapping[str, DataFrame],
    sessions: Iterable[str] | None = None,
    tolerance: timedelta = TOLERANCE,
    base_date: str = DEFAULT_BASE_DATE,
) -> Integration:
    """Integrate the named sessions, or every session, in one job.

    Per session the log with the fewest rows is the spine. Each distinct moment of the spine
    becomes one row: the spine row of that moment with the highest sequence number, filled
    from the other logs in declared order, from each by its latest row within `tolerance`.
    Sessions without rows in any log give none.

    One pass over keys and clocks alone counts rows, picks spines, finds the midnights and, on
    its ticks, chooses which row of each log serves which moment. Then the logs, as one table,
    are joined to the chosen ticks, and only chosen rows are shuffled once more to meet.
    """
    sessions = None if sessions is None else list(dict.fromkeys(sessions))
    read = reader if callable(reader) else reader.__getitem__
    columns = {
        s.name: [c for c in target.columns if c in s.merge_columns and c not in target.keys]
        for s in target.sources
    }

    def packed(log: Callable[[SourceSpec], DataFrame]) -> DataFrame:
        logs = (
            log(s)
            .withColumn("__digits", clock_digits(F.col(s.clock)))
            .selectExpr(
                KEY,
                SEQUENCE,
                "__digits AS clock",
                REJECTED_CLOCK,
                f"{number} AS source",
                pack(s.name, columns[s.name]),
            )
            for number, s in enumerate(target.sources)
        )
        return reduce(_union, logs)

    rows = packed(lambda s: normalize(read(s.name), s, sessions, REJECTED_CLOCK))
    numbers = list(range(len(columns)))
    placement = Placement(rows, "clock", numbers, base_date)
    if sessions is not None:
        placement.warn_of_missing(sessions)

    def fused() -> DataFrame:
        partners = latest_partners(
            placement.instants, numbers, [KEY], EVENT_US, "source", "is_main", tolerance, ["seq"]
        )
        # As a table its size is known, so that few chosen ticks are broadcast to the logs.
        partners = materialize(partners, "partners")
        same_tick = [(SEQUENCE, "seq"), ("clock", "clock")]
        chosen = fuse_chosen(
            rows.drop(REJECTED_CLOCK), partners, columns, [KEY], same_tick, EVENT_US, "source", numbers
        ).withColumn(EVENT_TS, from_micros(F.col(EVENT_US)))
        return _to_target(chosen, list(columns), target.schema)

    def rejected() -> DataFrame:
        lost = placement.timeless
        if sessions is None:
            lost = lost.unionByName(
                packed(lambda s: without_session(read(s.name), s, REJECTED_CLOCK))
            )
        reason = reject_reason(F.col(KEY), F.col("clock"), F.col(REJECTED_CLOCK))
        lost = lost.withColumn(REASON, reason).selectExpr(
            KEY, "source", REJECTED_CLOCK, REASON, *unpack(columns)
        )
        return _to_target(lost, list(columns), reject_schema(target.schema))

    return Integration(fused, rejected)


def _union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def _to_target(df: DataFrame, names: list[str], schema: T.StructType) -> DataFrame:
    """In the target's layout, with the log's name for its number."""
    name = F.get(F.array(*map(F.lit, names)), F.col("source"))
    return project_to_target(df.withColumn(SOURCE_TABLE, name).drop("source"), schema)
