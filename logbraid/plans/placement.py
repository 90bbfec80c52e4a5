"""Placing the rows of many logs in time, for every session at once."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logbraid.functions.lineage import materialize
from logbraid.functions.times import event_micros
from logbraid.operators.clock import clock_parts, clock_ticks, group_sizes, tick_days
from logbraid.operators.profile import choose_main
from logbraid.sources.registry import KEY, SEQUENCE

log = logging.getLogger(__name__)

_GROUP = ["source", KEY]
EVENT_US = "event_us"


class Placement:
    """What one pass over keys and clocks tells: when the ticks of every log and session were,
    how many rows each has, and which log is the spine of each session.

    `rows` are those of all logs in one layout, each with the number of its log as `source` and
    its clock as a number, as both travel with every tick; `declared` has the numbers in order.
    Everything is computed on first use.
    """

    def __init__(
        self, rows: DataFrame, clock: str, declared: Sequence[int], base_date: str
    ) -> None:
        self._rows, self._clock, self._declared = rows, clock, declared
        self._base_date = base_date

    @cached_property
    def _parts(self) -> DataFrame:
        return clock_parts(clock_ticks(self._rows, _GROUP, SEQUENCE, self._clock), _GROUP)

    @cached_property
    def mains(self) -> DataFrame:
        """(session, main): the spine of each session."""
        return materialize(choose_main(group_sizes(self._parts, _GROUP), self._declared), "mains")

    def warn_of_missing(self, sessions: Sequence[str]) -> None:
        found = {row[0] for row in self.mains.select(KEY).collect()}
        for missing in (s for s in sessions if s not in found):
            log.warning("No data found for session %s", missing)

    @property
    def instants(self) -> DataFrame:
        """(session, event_us, source, seq, clock, is_main): per log and instant the tick with
        the highest sequence number, and some others. At one instant all ticks of a log have one
        clock. Times are whole microseconds, which cost less than timestamps to compare.

        Ticks of an instant follow each other, so the pass over the ticks has seen already which
        are followed by another, and no shuffle is needed to leave those out. What is left are
        ticks that a missing clock or the end of a part stands between.
        """
        timed = tick_days(self._parts, _GROUP, "NOT followed").select(
            *_GROUP, self._time().alias(EVENT_US), "seq", "clock"
        )
        timed = timed.where(F.col(EVENT_US).isNotNull())
        is_main = (F.col("source") == F.col("main")).alias("is_main")
        return timed.join(self.mains, KEY).select(*timed.columns, is_main)

    def _time(self) -> Column:
        return event_micros(F.col("clock"), F.col("day"), self._base_date)

    @property
    def timeless(self) -> DataFrame:
        """Spine rows without an event time."""
        mains = self.mains.withColumnRenamed(KEY, "main_key")
        spine = self._rows.join(
            mains, (F.col(KEY) == F.col("main_key")) & (F.col("source") == F.col("main"))
        ).select(*self._rows.columns)
        lost = tick_days(self._parts, _GROUP).where(
            self._time().isNull() & F.col("clock").isNotNull()
        )
        # A clock is missing, or its day is past all timestamps.
        lost = lost.select(*(F.col(c).alias(f"lost_{c}") for c in (*_GROUP, "seq", "clock")))
        # As a table its size is known: where few are lost, nothing wide is shuffled to meet them.
        lost = materialize(lost, "lost")
        same = [F.col(c) == F.col(f"lost_{c}") for c in (*_GROUP, "clock")]
        same.append(
            F.col(SEQUENCE).cast("bigint").eqNullSafe(F.col("lost_seq"))
        )
        untimed = F.col(self._clock).isNull()
        return spine.where(untimed).unionByName(spine.where(~untimed).join(lost, same, "left_semi"))
