from __future__ import annotations

import random
import re
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import event_logs
from logbraid.functions.times import valid_clock
from logbraid.operators import clock as clocks
from logbraid.operators.clock import unwrap_clock, with_previous_clock
from logbraid.operators.normalize import processed
from logbraid.operators.target import split_valid
from logbraid.sources.registry import SOURCES

SCHEMA = "key string, seq_no long, clock string"


def at(day: int, clock: str) -> datetime:
    return datetime.fromisoformat(f"1970-01-01 {clock}") + timedelta(days=day - 1)


def plain_unwrap(rows):
    """The rule, row by row."""
    placed, previous, day = {}, {}, {}
    order = lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "")
    for key, seq, clock in sorted(rows, key=order):
        before = previous.get(key)
        if clock is not None and before is not None and clock < before:
            day[key] = day.get(key, 0) + 1
        previous[key] = clock
        placed[key, seq, clock] = None if clock is None else at(day.get(key, 0) + 1, clock)
    return placed


def unwrap(spark, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema).repartition(5)
    got = unwrap_clock(df, ["key"], "seq_no", "clock").collect()
    assert len(got) == len(rows)
    return {(r.key, r.seq_no, r.clock): r.event_ts for r in got}


T1 = ["23:59:58.000", "23:59:59.500", "00:00:00.200", "12:00:00.000", "00:00:01.000"]


@pytest.fixture(params=["ranges", "ticks"])
def path(request, monkeypatch):
    """Both ways to look days up: broadcast day ranges, and a join to ticks."""
    if request.param == "ticks":
        monkeypatch.setattr(clocks, "MAX_RANGES_PER_GROUP", 0)


@pytest.mark.parametrize(
    "read,days",
    [
        (T1, [1, 1, 2, 2, 3]),
        (["23:00:00.000", None, "01:00:00.000"], [1, None, 1]),
        (["10:00:00.000", "09:59:59.900", "10:00:00.100"], [1, 2, 2]),
        (["10:00:00.000", "10:00:00.000"], [1, 1]),
    ],
    ids=["rollover", "null", "jitter", "equal"],
)
def test_days(spark, path, read, days):
    got = unwrap(spark, [("S1", i, c) for i, c in enumerate(read)])
    for i, (c, day) in enumerate(zip(read, days)):
        assert got["S1", i, c] == (None if c is None else at(day, c))


def test_groups_and_input_order(spark, path):
    rows = [("S1", i, c) for i, c in enumerate(T1)] + [("S2", 1, "00:00:00.000")]
    random.Random(7).shuffle(rows)
    assert unwrap(spark, rows) == plain_unwrap(rows)


def test_malformed_clocks_are_rejected(spark, log_frame):
    spec = SOURCES["ir_msl"]
    rows = [
        {"sortie_number": "S1", "message_sequence_number": i, "satellite_guidance_time": c}
        for i, c in enumerate(["24:00:01.000", "9:00", "10:00:00.000", "10:60:00.000", "10:00:00"])
    ]
    valid, rejected = split_valid(processed(log_frame(spec, rows), spec))
    assert [r.event_ts for r in valid.collect()] == [datetime(1970, 1, 1, 10)]
    assert rejected.count() == 4


CLOCKS = st.one_of(
    st.none(), st.sampled_from(["00:00:00.000", "06:00:00.000", "12:00:00.500", "23:59:59.999"])
)


@settings(max_examples=6, deadline=None)
@given(
    rows=st.lists(
        st.tuples(
            st.sampled_from(["A", "B"]), st.one_of(st.none(), st.integers(-3, 12)), CLOCKS
        ),
        min_size=1,
        max_size=60,
    ),
    ticks=st.booleans(),
)
def test_any_rows_in_any_number_of_parts(spark, rows, ticks):
    """Copies, ties, NULLs and jitter, with groups cut across parts."""
    limit = clocks.MAX_RANGES_PER_GROUP
    clocks.MAX_RANGES_PER_GROUP = 0 if ticks else limit
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert unwrap(spark, rows) == plain_unwrap(rows)
    finally:
        clocks.MAX_RANGES_PER_GROUP = limit
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_one_group_spreads_over_parts(spark):
    df = spark.range(20_000).select(
        F.lit("S1").alias("key"), F.col("id").alias("seq_no"), F.lit("10:00:00.000").alias("clock")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = clocks.clock_parts(clocks.clock_ticks(df, ["key"], "seq_no", "clock"), ["key"])
        assert parts.select("part").distinct().count() > 4
        assert clocks.group_sizes(parts, ["key"]).first().n == 20_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_copies_are_counted_before_the_shuffle(spark):
    df = spark.range(1000).select(F.lit("k").alias("key"), F.lit(1).alias("s"), F.lit("c").alias("c"))
    plan = clocks.clock_ticks(df, ["key"], "s", "c")._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange")
    assert plan.index("partial_count") > exchange > plan.index("HashAggregate")


def test_only_rows_of_a_jittery_group_meet_ticks(spark, monkeypatch):
    """One jittery session among calm ones, whose number does not change the plan."""
    passes, met = [], []
    real_parts, real_join = clocks.clock_parts, clocks.join_ticks
    monkeypatch.setattr(clocks, "clock_parts", lambda *a: passes.append(1) or real_parts(*a))

    def join_ticks(df, ticks, *rest):
        met.append((df.count(), ticks.count()))
        return real_join(df, ticks, *rest)

    monkeypatch.setattr(clocks, "join_ticks", join_ticks)
    jitter = [("J", i, "10:00:00.000" if i % 2 else "10:00:00.020") for i in range(400)]
    calm = [(f"C{s}", i, c) for s in range(50) for i, c in enumerate(T1)]
    assert unwrap(spark, jitter + calm) == plain_unwrap(jitter + calm)
    assert passes == [1] and met == [(400, 400)]

    def shape(n):
        met.clear()
        keys = spark.range(n).select(F.concat(F.lit("C"), "id").alias("key"))
        rows = keys.crossJoin(spark.createDataFrame(list(enumerate(T1)), "seq_no long, clock string"))
        plan = unwrap_clock(rows, ["key"], "seq_no", "clock")._jdf.queryExecution().optimizedPlan()
        assert not met
        return [re.sub(r"Range .*|[#\[].*", "", x).strip() for x in plan.toString().splitlines()]

    assert shape(10) == shape(20_000)


def test_a_day_past_all_timestamps_is_no_time(spark):
    from logbraid.functions.times import LAST_DAY, event_time

    days = [0, LAST_DAY, LAST_DAY + 1, 106_751_992, 2**40, None]
    df = spark.createDataFrame([("10:00:00.000", d) for d in days], "clock string, day long")
    got = [r[0] for r in df.select(event_time(F.col("clock"), F.col("day")).isNotNull()).collect()]
    assert got == [True, True, False, False, False, False]


def test_previous_clock(spark):
    rows = [("S1", i, c) for i, c in enumerate([*T1, None, "02:00:00.000"])]
    df = spark.createDataFrame(rows, SCHEMA)
    got = with_previous_clock(df, ["key"], "seq_no", "clock").orderBy("seq_no").collect()
    assert [r.previous for r in got] == [None, *T1, None]
    assert [r.wrapped for r in got] == [0, 0, 1, 0, 1, 0, 0]


def test_true_time_comes_back(spark):
    """Logs without a silent day get their true times back, up to the clock's millisecond."""
    rows = event_logs.events(spark, "/root/testdata/sf0.01").selectExpr(
        "'all' AS key", "event_id", "ts", "date_format(ts, 'HH:mm:ss.SSS') AS clock"
    )
    first = rows.agg(F.min("ts")).first()[0]
    placed = unwrap_clock(rows, ["key"], "event_id", "clock", base_date=str(first.date()))
    true = F.date_trunc("millisecond", "ts").cast("timestamp_ntz")
    assert placed.where(~F.col("event_ts").eqNullSafe(true)).count() == 0


def test_valid_clock_keeps_only_times_of_day(spark):
    df = spark.createDataFrame([("00:00:00.000",), ("23:59:59.999",), ("24:00:00.000",), (" 1:00:00.000",)], "c string")
    assert [r[0] for r in df.select(valid_clock(F.col("c"))).collect()] == [
        "00:00:00.000", "23:59:59.999", None, None,
    ]
