"""Rebuilding full timestamps from a time-of-day clock that wraps at midnight.

A row's clock is compared with the clock of the row before it in sequence order, within its
group. Each time it is smaller a midnight has passed; the running count of midnights is the
row's day. An equal clock, and a NULL on either side, is no midnight.

The order is by sequence number, then clock, NULLs first. So rows alike in both share a day,
and the day is a function of the group and the *tick* (sequence number, clock). The work
below runs on distinct ticks, which are narrow, and never on one group in one task:

1. Ticks are range-partitioned over (group, sequence, clock). A group of any size spreads
   over many parts, and copies of a tick have been counted before the shuffle.
2. Within a part, LAG and a running SUM give days counted from the part's first tick. This
   pass runs once; its narrow outcome is kept as a table.
3. Per group, the first and last clock and the day count of each part say how many days to
   add to the part. This step sees one row per part, whatever the data's size.

Ticks of one day follow each other, so a group's days are mostly a handful of ranges. Rows of
such a calm group look their day up in the group's ranges, after a join on the group alone.
Only rows of a group whose clock jitters, so that its ranges are many, are joined to ticks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logbraid.functions.lineage import materialize
from logbraid.functions.times import DEFAULT_BASE_DATE, event_time

# A group of up to so many ranges is calm: each of its rows scans them.
MAX_RANGES_PER_GROUP = 64


def _tick() -> Column:
    return F.struct(F.col("seq"), F.col("clock"))


def wraps(clock: Column, previous: Column) -> Column:
    """1 if the clock went back since `previous`, else 0."""
    return F.when(clock < previous, 1).otherwise(0)


def clock_ticks(df: DataFrame, keys: Sequence[str], order: str, clock: str) -> DataFrame:
    """Distinct (keys, seq, clock) with the number `n` of rows at each."""
    return df.groupBy(
        *keys, F.col(order).cast("bigint").alias("seq"), F.col(clock).alias("clock")
    ).agg(F.count(F.lit(1)).alias("n"))


def _in_parts(ticks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Ticks with their `part`; there the clock `previous` to them, the `run` of days since
    the part's first tick, the rows `through` them, whether a run `starts` or `ends`, and whether
    they are `followed` by a tick of the same instant."""
    parts = ticks.repartitionByRange(*keys, "seq", "clock").withColumn(
        "part", F.spark_partition_id()
    )
    in_part = Window.partitionBy("part", *keys).orderBy("seq", "clock")
    so_far = in_part.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    beside = parts.select(
        "*",
        F.lag("clock").over(in_part).alias("previous"),
        F.lead("clock").over(in_part).alias("following"),
        F.lag(F.lit(False), 1, True).over(in_part).alias("opens"),
        F.lead(F.lit(False), 1, True).over(in_part).alias("closes"),
    )
    wrapped = wraps(F.col("clock"), F.col("previous"))
    return beside.select(
        *keys,
        "part",
        "seq",
        "clock",
        "previous",
        (F.col("opens") | (wrapped == 1)).alias("starts"),
        (F.col("closes") | (wraps(F.col("following"), F.col("clock")) == 1)).alias("ends"),
        F.sum(wrapped).over(so_far).alias("run"),
        F.sum("n").over(so_far).alias("through"),
        F.coalesce(F.col("following") == F.col("clock"), F.lit(False)).alias("followed"),
    )


def _edges(bounds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per group and part: its first and last tick and clock, days passed, rows held.

    `bounds` are ticks that hold at least every start and end of a run.
    """
    return bounds.groupBy(*keys, "part").agg(
        F.min(_tick()).alias("first_tick"),
        F.min_by("clock", _tick()).alias("first_clock"),
        F.max_by("clock", _tick()).alias("last_clock"),
        F.max("run").alias("runs"),
        F.max("through").alias("n"),
    )


def _part_offsets(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Days to add per part, and the last clock `before` it.

    One row per group and part, as a table: where Spark knows that they are few, the ticks need
    no shuffle to meet them.
    """
    by_part = Window.partitionBy(*keys).orderBy("part")
    so_far = by_part.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    passed = wraps(F.col("first_clock"), F.col("before")) + F.col("runs_before")
    offsets = (
        edges.withColumn("before", F.lag("last_clock").over(by_part))
        .withColumn("runs_before", F.lag("runs", 1, 0).over(by_part))
        .select(*keys, "part", "first_tick", "before", F.sum(passed).over(so_far).alias("offset"))
    )
    return materialize(offsets, "part_offsets")


def clock_parts(ticks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The outcome of the clock pass, materialized: each tick in its part."""
    return materialize(_in_parts(ticks, keys), "ticks")


def _bounds(parts: DataFrame) -> DataFrame:
    return parts.where("starts OR ends")


def group_sizes(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n): the number of rows, not ticks, of each group."""
    return _edges(_bounds(parts), keys).groupBy(*keys).agg(F.sum("n").alias("n"))


def day_ranges(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, day, first, last): the first and last tick of each group's days."""
    bounds = _bounds(parts)
    offsets = _part_offsets(_edges(bounds, keys), keys)
    return (
        bounds.join(offsets, [*keys, "part"])
        .groupBy(*keys, (F.col("run") + F.col("offset")).alias("day"))
        .agg(F.min(_tick()).alias("first"), F.max(_tick()).alias("last"))
    )


def group_ranges(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, ranges): the day ranges of each group, NULL where they are many."""
    in_order = Window.partitionBy(*keys).orderBy("day")
    place = F.row_number().over(in_order)
    few = day_ranges(parts, keys).withColumn("place", place)
    # One more than may be kept tells that there are too many.
    few = few.where(F.col("place") <= MAX_RANGES_PER_GROUP + 1)
    ranges = F.collect_list(F.struct("first", "last", "day"))
    calm = F.count(F.lit(1)) <= MAX_RANGES_PER_GROUP
    return few.groupBy(*keys).agg(F.when(calm, ranges).alias("ranges"))


def tick_days(parts: DataFrame, keys: Sequence[str], only: str = "true") -> DataFrame:
    """(keys, seq, clock, previous, wrapped, day) of every distinct tick, or of those of a
    condition. Right for any number of midnights."""
    offsets = _part_offsets(_edges(_bounds(parts), keys), keys)
    opens_part = _tick() == F.col("first_tick")
    return (
        parts.where(only)
        .join(offsets, [*keys, "part"])
        .withColumn("previous", F.when(opens_part, F.col("before")).otherwise(F.col("previous")))
        .select(
            *keys,
            "seq",
            "clock",
            "previous",
            wraps(F.col("clock"), F.col("previous")).alias("wrapped"),
            (F.col("run") + F.col("offset")).alias("day"),
        )
    )


def join_ticks(
    df: DataFrame, ticks: DataFrame, keys: Sequence[str], order: str, clock: str
) -> DataFrame:
    """`df` with all further columns of its own tick, by a shuffled join."""
    side = ticks.withColumnsRenamed(
        {**{k: f"tick_{k}" for k in keys}, "seq": "tick_seq", "clock": "tick_clock"}
    )
    same_group = [df[k] == side[f"tick_{k}"] for k in keys]
    same_tick = [
        df[order].cast("bigint").eqNullSafe(side["tick_seq"]),
        df[clock].eqNullSafe(side["tick_clock"]),
    ]
    return df.join(side, [*same_group, *same_tick], "left").drop(
        *(f"tick_{k}" for k in keys), "tick_seq", "tick_clock"
    )


def with_previous_clock(
    df: DataFrame, keys: Sequence[str], order: str, clock: str
) -> DataFrame:
    """`df` with the clock `previous` to each row's tick in sequence order, whether the clock
    `wrapped` since, and the `day` it has reached."""
    parts = clock_parts(clock_ticks(df, keys, order, clock), keys)
    return join_ticks(df, tick_days(parts, keys), keys, order, clock)


def with_day(df: DataFrame, keys: Sequence[str], order: str, clock: str) -> DataFrame:
    """`df` with the `day` its clock has reached, counted from 0.

    Each group goes its own way: rows of calm groups find their day in the group's ranges, rows
    of the others by their tick. The join on the group leaves it to Spark whether the groups are
    broadcast, and can be split where a group holds many rows.
    """
    return _days_from(clock_parts(clock_ticks(df, keys, order, clock), keys), df, keys, order, clock)


def with_day_onwards(
    df: DataFrame, keys: Sequence[str], order: str, clock: str, last: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(`df` with its `day`, the last ticks then): as `with_day` of all rows there were, where `df`
    holds those after the ticks `last` (keys, seq, clock, day), one per group seen before.

    A group's last tick goes through the pass as its first one, on day 0, and the day it was on is
    added to what follows.
    """
    seeds = last.select(*keys, "seq", "clock", F.lit(0).cast("bigint").alias("n"))
    ticks = clock_ticks(df, keys, order, clock).unionByName(seeds)
    parts = clock_parts(ticks, keys)
    before = last.select(*(F.col(k).alias(f"before_{k}") for k in keys), F.col("day").alias("base"))

    def added(days: DataFrame) -> DataFrame:
        same = [days[k] == before[f"before_{k}"] for k in keys]
        base = F.coalesce("base", F.lit(0))
        joined = days.join(before, same, "left").withColumn("day", F.col("day") + base)
        return joined.select(*days.columns)

    reached = tick_days(parts, keys).groupBy(*keys).agg(F.max(F.struct("seq", "clock", "day")).alias("t"))
    return (
        added(_days_from(parts, df, keys, order, clock)),
        added(reached.select(*keys, "t.seq", "t.clock", "t.day")),
    )


def _days_from(
    parts: DataFrame, df: DataFrame, keys: Sequence[str], order: str, clock: str
) -> DataFrame:
    """`df` with the `day` of its ticks, which are among those in `parts`."""
    groups = materialize(group_ranges(parts, keys), "group_ranges")
    side = groups.withColumnsRenamed({k: f"group_{k}" for k in keys}).withColumn(
        "jittery", F.col("ranges").isNull()
    )
    grouped = df.join(side, [df[k] == side[f"group_{k}"] for k in keys], "left").drop(
        *(f"group_{k}" for k in keys)
    )
    tick = F.struct(F.col(order).cast("bigint").alias("seq"), F.col(clock).alias("clock"))
    own = F.filter("ranges", lambda r: (tick >= r["first"]) & (tick <= r["last"]))
    calm = grouped.where(~F.coalesce("jittery", F.lit(False)))
    calm = calm.withColumn("day", F.get(own, 0)["day"]).drop("ranges", "jittery")
    jittery_groups = groups.where(F.col("ranges").isNull()).select(*keys)
    if jittery_groups.isEmpty():
        return calm
    jittery = df.join(jittery_groups, list(keys), "left_semi").select(*df.columns)
    theirs = tick_days(parts.join(jittery_groups, list(keys), "left_semi"), keys)
    days = theirs.select(*keys, "seq", "clock", "day")
    return calm.unionByName(join_ticks(jittery, days, keys, order, clock))


def unwrap_clock(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    clock: str,
    base_date: str = DEFAULT_BASE_DATE,
    into: str = "event_ts",
) -> DataFrame:
    """`df` with the full timestamp `into`, the first row of each group being on `base_date`.

    NULL clocks give NULL timestamps. Each group is unwrapped on its own from day 0, and a
    silence of a day or more cannot be seen.
    """
    placed = with_day(df, keys, order, clock)
    return placed.withColumn(into, event_time(F.col(clock), F.col("day"), base_date)).drop("day")
