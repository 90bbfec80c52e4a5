from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta
from functools import reduce

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from logbraid.operators.bandjoin import band_left_join, star_band_join
from logbraid.operators.fuse import fuse, fuse_latest, pack

SECOND = timedelta(seconds=1)
LEFT = "k string, ts timestamp_ntz, l string"
RIGHT = "k string, ts timestamp_ntz, r string"


def t(seconds: float) -> datetime:
    return datetime(1970, 1, 1, 10) + timedelta(milliseconds=round(seconds * 1000))


def rows(df) -> Counter:
    return Counter(map(tuple, df.collect()))


def test_band_limits(spark):
    left = spark.createDataFrame([("S1", t(0), "a")], LEFT)
    right = spark.createDataFrame(
        [("S1", t(x), str(x)) for x in (-1.001, -1.0, 1.0, 1.001)], RIGHT
    )
    joined = band_left_join(left, right, ["k"], "ts", SECOND)
    assert sorted(r.r for r in joined.collect()) == ["-1.0", "1.0"]


def test_rows_without_match_stay_once(spark):
    left = spark.createDataFrame(
        [("S1", t(0), "far"), ("S1", None, "no time"), ("S1", None, "no time"),
         ("S1", t(50), "other key"), (None, t(50), "no key")], LEFT
    )
    right = spark.createDataFrame(
        [("S1", t(9), "x"), ("S2", t(50), "y"), ("S1", None, "z"), (None, t(50), "w")], RIGHT
    )
    got = rows(band_left_join(left, right, ["k"], "ts", SECOND).select("l", "r"))
    assert got == Counter({("far", None): 1, ("no time", None): 2, ("other key", None): 1, ("no key", None): 1})


def test_star_fans_out(spark):
    main = spark.createDataFrame([("S1", t(0), "m")], LEFT)
    a = spark.createDataFrame([("S1", t(x), f"a{x}") for x in (0.1, 0.2)], RIGHT)
    b = spark.createDataFrame([("S1", t(x), f"b{x}") for x in (-0.3, 0.4, 0.5)], RIGHT)
    star = star_band_join(main, {"a": a, "b": b}, ["k"], "ts", SECOND)
    assert star.count() == 6 and star.columns == ["k", "ts", "l", "a__r", "b__r"]


@pytest.mark.parametrize("tolerance", [timedelta(0), timedelta(milliseconds=7), SECOND])
def test_buckets_equal_all_pairs(spark, tolerance):
    rng = random.Random(3)
    stamp = lambda: rng.choice([None] + [t(rng.randint(0, 4000) / 1000) for _ in range(9)])
    left = spark.createDataFrame([(rng.choice("AB"), stamp(), str(i)) for i in range(300)], LEFT)
    right = spark.createDataFrame([(rng.choice("AB"), stamp(), str(i)) for i in range(300)], RIGHT)
    right = right.union(right.limit(20))
    other = right.withColumnsRenamed({"k": "k2", "ts": "ts2"})
    width = F.lit(tolerance)
    naive = left.join(
        other,
        (F.col("k") == F.col("k2")) & F.col("ts2").between(F.col("ts") - width, F.col("ts") + width),
        "left",
    ).select("k", "ts", "l", "r")
    assert rows(band_left_join(left, right, ["k"], "ts", tolerance)) == rows(naive)


def test_precedence(spark):
    schema = "k string, ts timestamp_ntz, weapon_type string"
    a = spark.createDataFrame([("S1", t(0.1), "X")], schema)
    b = spark.createDataFrame([("S1", t(0.2), "Y")], schema)
    for value, expected in ((None, "X"), ("M", "M"), ("", "")):
        main = spark.createDataFrame([("S1", t(0), value)], schema)
        assert fuse(main, {"a": a, "b": b}, ["k"], "ts", SECOND).first().weapon_type == expected


def placed_logs(spark, seed, spread):
    """Three logs of two sessions, one row per session and instant; either may be a spine."""
    rng = random.Random(seed)
    main_of = {"A": "x", "B": "z"}
    logs = {}
    for name, columns in (("x", "p q"), ("y", "q s"), ("z", "p s")):
        first, second = columns.split()
        cell = lambda c, i: rng.choice([None, f"{name}.{c}.{i}"])
        data = [
            (k, t(x / 1000), k in main_of and main_of[k] == name, cell(first, x), cell(second, x))
            for k in ("A", "B", "C")
            for x in rng.sample(range(spread), 25)
        ]
        logs[name] = spark.createDataFrame(
            data, f"k string, ts timestamp_ntz, is_main boolean, {first} string, {second} string"
        )
    return logs, main_of


@pytest.mark.parametrize("tolerance", [timedelta(0), timedelta(milliseconds=60), SECOND])
@pytest.mark.parametrize("spread", [400, 40_000])
def test_latest_is_one_of_the_combinations(spark, tolerance, spread):
    """`fuse_latest` equals picking from `fuse`'s combinations the one with the latest
    partners."""
    logs, main_of = placed_logs(spark, spread, spread)
    columns = {n: df.columns[3:] for n, df in logs.items()}
    together = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        (
            df.selectExpr("k", "ts", "is_main", f"'{n}' AS log", pack(n, columns[n]))
            for n, df in logs.items()
        ),
    )
    got = fuse_latest(together, columns, ["k"], "ts", "log", "is_main", tolerance)
    expected = Counter()
    for session, name in main_of.items():
        of_session = {
            n: df.where(F.col("k") == session).drop("is_main").withColumn(f"at_{n}", F.col("ts"))
            for n, df in logs.items()
        }
        main = of_session.pop(name)
        pairs = fuse(main, of_session, ["k"], "ts", tolerance)
        latest = Window.partitionBy("ts").orderBy(*(F.desc_nulls_last(f"at_{n}") for n in of_session))
        picked = pairs.withColumn("rn", F.row_number().over(latest)).where("rn = 1")
        expected += rows(picked.select("k", "ts", "p", "q", "s", F.lit(name)))
    assert rows(got.select("k", "ts", "p", "q", "s", "log")) == expected
    assert got.count() == 50


def test_no_time_zone_shifts_the_bands(spark):
    """Local times that daylight saving skips or repeats are still times."""
    at = lambda h, m, s: datetime(2024, 3, 10, h, m, s)
    left = spark.createDataFrame([("S1", at(1, 59, 59), "a"), ("S1", at(3, 0, 0), "b")], LEFT)
    right = spark.createDataFrame([("S1", at(2, 0, 0), "x"), ("S1", at(2, 59, 59), "y")], RIGHT)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = rows(band_left_join(left, right, ["k"], "ts", SECOND).select("l", "r"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == Counter({("a", "x"): 1, ("b", "y"): 1})


def test_star_plan_does_not_grow_by_doubling(spark):
    """Each join of the star scans main's rows once more for their instants, and no more."""
    main = spark.range(5).selectExpr("'S1' AS k", "timestamp_ntz'1970-01-01 10:00:00' AS ts", "id AS l")
    other = main.withColumnRenamed("l", "r")
    scans = lambda n: star_band_join(
        main, {f"o{i}": other for i in range(n)}, ["k"], "ts", SECOND
    )._jdf.queryExecution().executedPlan().toString().count("Range (0, 5")
    assert scans(4) - scans(3) == scans(3) - scans(2) == scans(2) - scans(1)


def test_the_size_of_a_star_is_known_before_it_is_formed(spark, caplog):
    """A dense toy: repeated instants, logs without rows, NULL times and keys."""
    import logging
    import random

    from logbraid.operators.bandjoin import StarTooLarge, star_sizes

    pick = random.Random(3)
    at = lambda s: None if s is None else datetime(1970, 1, 1) + timedelta(seconds=s)

    def log_of(n, name):
        rows = [
            (pick.choice(["A", "A", "B", None]), at(pick.choice([None, *range(12)])), i)
            for i in range(n)
        ]
        return spark.createDataFrame(rows, f"k string, ts timestamp_ntz, {name} long")

    main = log_of(60, "m")
    others = {"x": log_of(30, "x"), "y": log_of(25, "y"), "none": log_of(0, "z")}
    for seconds in (0, 2):
        star = star_band_join(main, others, ["k"], "ts", timedelta(seconds=seconds))
        want = {r.k: r["count"] for r in star.groupBy("k").count().collect()}
        sizes = star_sizes(main, others, ["k"], "ts", timedelta(seconds=seconds))
        assert {r.k: r["rows"] for r in sizes.collect()} == want
    total = sum(want.values())
    assert total > 5 * 60
    with caplog.at_level(logging.INFO), pytest.raises(StarTooLarge, match=f"{total} rows, most of them of .*'{max(want, key=want.get)}'"):
        fuse(main, others, ["k"], "ts", timedelta(seconds=2), most_rows=total - 1)
    assert f"has {total} rows" in caplog.text
    assert fuse(main, others, ["k"], "ts", timedelta(seconds=2), most_rows=total).count() == total


def test_a_pair_of_rows_costs_two_comparisons_of_numbers(spark):
    """The star's joins add no interval to a time, and test no flag, for every pair they meet."""
    left = spark.createDataFrame([("S1", t(0), "a"), ("S1", None, "b")], LEFT)
    right = spark.createDataFrame([("S1", t(1), "x"), ("S1", t(2), "y")], RIGHT)
    for joined in (
        band_left_join(left, right, ["k"], "ts", SECOND),
        star_band_join(left, {"a": right, "b": right}, ["k"], "ts", SECOND),
    ):
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
        conditions = [line for line in plan.splitlines() if "Join Inner" in line or "Join LeftAnti" in line]
        assert conditions and all("__us" in c and "INTERVAL" not in c and "__lonely" not in c for c in conditions)
        assert all("cast(" not in c for c in conditions)


@pytest.mark.parametrize("tolerance", [timedelta(0), timedelta(milliseconds=700), timedelta(seconds=3)])
def test_a_star_of_many_chunks_equals_all_pairs(spark, monkeypatch, tolerance):
    """Buckets of many chunks, with repeated rows, missing times and keys, and a log of structs."""
    from logbraid.operators import bandjoin

    monkeypatch.setattr(bandjoin, "MOST_IN_CHUNK", 3, raising=False)
    monkeypatch.setattr(bandjoin, "MOST_COMBINATIONS", 9, raising=False)
    rng = random.Random(11)
    key = lambda: rng.choice(["A", "A", "B", None])
    stamp = lambda: rng.choice([None] + [t(rng.randint(0, 60) / 10) for _ in range(9)])
    many = lambda n: [(key(), stamp(), rng.choice([None, *range(9)])) for _ in range(n)]
    main = spark.createDataFrame(many(70) + [("C", t(1), 1)] * 2, "k string, ts timestamp_ntz, l int")
    a = spark.createDataFrame(many(40), "k string, ts timestamp_ntz, r int")
    b = spark.createDataFrame(many(15), "k string, ts timestamp_ntz, r int")
    b = b.select("k", "ts", F.struct(F.col("r").alias("x")).alias("r"))
    star = star_band_join(main, {"a": a, "b": b}, ["k"], "ts", tolerance)
    assert star.columns == ["k", "ts", "l", "a__r", "b__r"]

    width, naive = F.lit(tolerance), main
    for name, other in (("a", a), ("b", b)):
        other = other.withColumnsRenamed({"k": "k2", "ts": "ts2", "r": f"{name}__r"})
        in_band = F.col("ts2").between(F.col("ts") - width, F.col("ts") + width)
        naive = naive.join(other, (F.col("k") == F.col("k2")) & in_band, "left").drop("k2", "ts2")
    assert rows(star) == rows(naive)
    assert rows(star.select("l", "b__r.x")) == rows(naive.select("l", "b__r.x"))


def test_one_instant_of_a_star_is_spread_over_tasks(spark):
    """All rows fall into one bucket, which is far too small for Spark to split it."""
    log_of = lambda n, c: spark.range(n).selectExpr(
        "concat('S', id % 1) AS k", "timestamp_ntz'1970-01-01 10:00:00' AS ts", f"id AS {c}"
    )
    star = star_band_join(
        log_of(1500, "l"), {"a": log_of(300, "r"), "b": log_of(2, "r")}, ["k"], "ts", SECOND
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as of logs of real size
    try:
        of_task = [r["count"] for r in star.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(of_task) == 1500 * 300 * 2
    assert len(of_task) > 3 and max(of_task) < sum(of_task) / 2


def test_rows_of_a_star_are_not_shuffled(spark):
    """What crosses the last shuffle are tuples of chunks, at most as many as chunks that meet."""
    log_of = lambda n, c: spark.range(n).selectExpr(
        "'S1' AS k", "timestamp_ntz'1970-01-01 10:00:00' + make_dt_interval(0, 0, 0, id) AS ts", f"id AS {c}"
    )
    star = star_band_join(
        log_of(200, "l"), {"a": log_of(200, "r"), "b": log_of(200, "r")}, ["k"], "ts", timedelta(seconds=30)
    )
    run = star._jdf.queryExecution()
    made = run.executedPlan().executeCollect()
    plan = run.executedPlan().toString()
    final = plan[plan.index("Final Plan"):].split("Initial Plan")[0]
    assert len(made) > 200 * 30 * 30
    assert "Exchange" in final
    assert "Join" not in final[: final.index("Exchange")]


def test_chunks_of_a_star_are_told_by_all_columns(spark):
    """A task that runs again must form the same chunks, whatever order its rows come in; columns
    without an order, as maps, still come through."""
    main = spark.createDataFrame([("S1", t(0), "m")], LEFT).withColumn("tags", F.create_map("l", "ts"))
    a = spark.createDataFrame([("S1", t(0.5), "x"), ("S1", t(0.5), "y")], RIGHT)
    star = star_band_join(main, {"a": a.withColumn("tags", F.create_map("r", "ts"))}, ["k"], "ts", SECOND)
    assert [(r.l, r.a__r, r.tags, r.a__tags) for r in star.orderBy("a__r").collect()] == [
        ("m", "x", {"m": t(0)}, {"x": t(0.5)}), ("m", "y", {"m": t(0)}, {"y": t(0.5)})
    ]
    plan = star._jdf.queryExecution().optimizedPlan().toString()
    numbered = [line for line in plan.splitlines() if "row_number()" in line and "Window" in line]
    assert len(numbered) == 2
    assert any("a__r" in line.split("ASC", 1)[1] for line in numbered)
    assert any(" l#" in line.split("ASC", 1)[1] for line in numbered)
