"""Unwrapping the clocks of a log that grows, from where the last run ended.

A run keeps, per session, the last tick it saw and the day reached there. The next run reads only
the blocks of the landed log from that tick's on, and of those the rows after it, and goes on
counting days. Both runs together give what one run over all rows gives.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logbraid.functions.lineage import materialize
from logbraid.functions.times import DEFAULT_BASE_DATE, event_time
from logbraid.operators.clock import with_day_onwards
from logbraid.operators.normalize import normalize
from logbraid.sources.generations import Generations
from logbraid.sources.lake import BLOCK, ROWS_PER_BLOCK
from logbraid.sources.registry import EVENT_TS, KEY, SEQUENCE, SOURCE_TABLE, SourceSpec

LAST_TICKS = T.StructType(
    [
        T.StructField(KEY, T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("clock", T.StringType()),
        T.StructField("day", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Onwards:
    """`rows` are the new ones, in the form of `processed`; `commit` lets the next run begin after
    them. Write the rows first: a run that stops before `commit` is done again alike, so write
    them where equal rows replace each other."""

    rows: DataFrame
    _last: DataFrame
    _state: Generations
    _version: int

    def commit(self) -> int:
        """Raises OtherWrite if another run went on from the same state."""
        return self._state.replace(self._last, [KEY], self._last.select(KEY), self._version)


def _from_blocks(last: DataFrame, numbers: int) -> Column:
    """Of each session the blocks from that of its last tick on; all of other sessions. One entry
    per session, as in the table's own list of partitions."""
    sessions: dict[int | None, list[str]] = defaultdict(list)
    block = F.floor(F.col("seq") / numbers)
    for session, first in last.select(KEY, block).collect():
        sessions[first].append(session)
    known = [s for some in sessions.values() for s in some]
    if not known:
        return F.lit(True)
    # Rows without a number come first; where they are all, any block may follow.
    parts = [
        F.col(KEY).isin(*some) & (F.lit(True) if first is None else F.col(BLOCK) >= first)
        for first, some in sessions.items()
    ]
    return reduce(or_, parts, ~F.col(KEY).isin(*known))


def unwrap_onwards(
    spark: SparkSession,
    spec: SourceSpec,
    log: str,
    state: str,
    base_date: str = DEFAULT_BASE_DATE,
    numbers: int = ROWS_PER_BLOCK,
) -> Onwards:
    """The rows that came to the landed `log` since the run that `state` tells of, with their
    event times.

    Rows count as seen up to the last tick (sequence number, clock) of their session, so a row that
    comes late, or a second one like the last, isn't read; land its log anew and unwrap it whole
    for that. `numbers` are the sequence numbers of a block, as it was landed. A session first seen
    begins on `base_date`.
    """
    held = Generations(spark, state, LAST_TICKS)
    version = held.version()
    last = materialize(held.read(version=version), "last_ticks")
    landed = spark.read.schema(spec.schema).parquet(log).where(_from_blocks(last, numbers))
    rows = normalize(landed.select(*spec.schema.names), spec)
    seen = last.select(
        F.col(KEY).alias("seen_key"), F.struct("seq", "clock").alias("seen_tick")
    )
    tick = F.struct(F.col(SEQUENCE).alias("seq"), F.col(spec.clock).alias("clock"))
    new = rows.join(seen, F.col(KEY) == F.col("seen_key"), "left").where(
        F.col("seen_key").isNull() | (tick > F.col("seen_tick"))
    )
    new = new.drop("seen_key", "seen_tick")
    placed, reached = with_day_onwards(new, [KEY], SEQUENCE, spec.clock, last)
    times = event_time(F.col(spec.clock), F.col("day"), base_date)
    placed = placed.withColumn(EVENT_TS, times).drop("day")
    placed = placed.withColumn(SOURCE_TABLE, F.lit(spec.name))
    return Onwards(placed, materialize(reached, "reached_ticks"), held, version)
