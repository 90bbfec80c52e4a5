from __future__ import annotations

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from logbraid.functions.lineage import checkpoint_dir, fresh_folder, materialize, scratch
from logbraid.operators.order import in_order, with_rank
from logbraid.sources import jdbc
from logbraid.sources.generations import Generations, OtherWrite
from logbraid.sources.lake import (
    land_log,
    read_table,
    read_target,
    read_kept,
    replace_sessions,
    touched_partitions,
    upsert_by_key,
    upsert_table,
)
from logbraid.sources.registry import MISSILE, SOURCES, SourceSpec, TargetSpec


def test_upsert_twice(spark):
    existing = spark.createDataFrame([("k1", "v1"), ("k2", "v2")], "k string, v string")
    updates = spark.createDataFrame([("k2", "v9"), ("k3", "v3")], "k string, v string")
    expected = {("k1", "v1"), ("k2", "v9"), ("k3", "v3")}
    once = upsert_by_key(existing, updates, ["k"])
    twice = upsert_by_key(once, updates, ["k"])
    assert set(map(tuple, once.collect())) == set(map(tuple, twice.collect())) == expected
    assert twice.count() == 3


def test_upsert_table(spark):
    target = TargetSpec("t", ("sortie_number", "event_ts", "v"), ())
    hour = lambda h: datetime(1970, 1, 1, h)
    frame = lambda *rows: spark.createDataFrame(rows, target.schema)
    path = fresh_folder(spark, "target")
    upsert_table(spark, path, frame(("007", hour(1), "a"), ("8", hour(1), "b")), target)
    update = frame(("007", hour(1), "A"), ("007", hour(2), "c"), ("9", hour(1), "d"))
    for _ in range(2):
        upsert_table(spark, path, update, target)
    got = read_target(spark, path, target)
    assert set(map(tuple, got.select(*target.columns).collect())) == {
        ("007", hour(1), "A"), ("007", hour(2), "c"), ("8", hour(1), "b"), ("9", hour(1), "d"),
    }
    assert got.count() == 4


def test_landed_sessions_prune_partitions(spark, log_frame):
    spec = SOURCES["ir_msl"]
    path = fresh_folder(spark, "landed")
    land_log(log_frame(spec, [{"sortie_number": s, "weapon_type": s} for s in ("1", "2", "02")]), path)
    one = read_table(spark, path, spec.schema, ["02"])
    assert [r.weapon_type for r in one.collect()] == ["02"]
    plan = one.select("weapon_type")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "sortie_number" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "ReadSchema: struct<weapon_type:string>" in plan


def test_order_and_rank(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("v")).repartition(6)
    ranked = with_rank(df, ["v"])
    assert ranked.where("rank <> v + 1").count() == 0 and ranked.count() == 1000
    parts = in_order(df, ["v"]).select("v", F.spark_partition_id().alias("p"))
    edges = parts.groupBy("p").agg(F.min("v"), F.max("v")).orderBy("p").collect()
    assert all(a[2] < b[1] for a, b in zip(edges, edges[1:]))


CONNECTION = jdbc.Connection("jdbc:mysql://host/db", "a.Driver", "u", "p")


def test_jdbc_options():
    read = jdbc.read_options(CONNECTION, "db.tspi", jdbc.Split(0, 900, 9))
    assert read == {
        "url": "jdbc:mysql://host/db", "driver": "a.Driver", "user": "u", "password": "p",
        "queryTimeout": "0", "dbtable": "db.tspi", "partitionColumn": "message_sequence_number",
        "lowerBound": "0", "upperBound": "900", "numPartitions": "9",
    }
    write = jdbc.write_options(CONNECTION, "db.out")
    assert write["batchsize"] == "1000" and write["dbtable"] == "db.out"
    assert "password" not in repr(CONNECTION)


def test_the_database_is_asked_for_the_extent_of_each_session():
    named = jdbc.extents_query("db.tspi", ["a", "o'b", "a"])
    assert named == (
        "SELECT sortie_number, COUNT(*) AS n, MIN(message_sequence_number) AS least, "
        "MAX(message_sequence_number) AS highest FROM db.tspi "
        "WHERE sortie_number IN ('a', 'o''b') GROUP BY sortie_number"
    )
    assert "WHERE sortie_number IS NOT NULL GROUP BY" in jdbc.extents_query("db.tspi")


def tspi_rows():
    """One session with a third of all rows, one in few numbers, one without, many small ones."""
    rows = [("big", 1000 + 3 * i) for i in range(3000)] + [("big", None)] * 40
    rows += [("narrow", i % 2) for i in range(900)] + [("unnumbered", None)] * 700
    rows += [(f"s{n}", i) for n in range(80) for i in range(n)] + [("o'b", -5), (None, 1)]
    return rows


@pytest.fixture(scope="module")
def tspi(spark):
    schema = "sortie_number string, message_sequence_number long"
    return spark.createDataFrame([(*r, i) for i, r in enumerate(tspi_rows())], f"{schema}, id long").cache()


@pytest.mark.parametrize("sessions", [None, ["big", "s7", "o'b", "none"]])
def test_every_row_meets_one_condition_of_a_scan(tspi, sessions):
    tspi.createOrReplaceTempView("tspi")
    told = tspi.sparkSession.sql(jdbc.extents_query("tspi", sessions)).collect()
    predicates = jdbc.scan_predicates([jdbc.Extent(*r) for r in told], rows_per_task=500)
    met = tspi.withColumn("met", sum(F.when(F.expr(p), 1).otherwise(0) for p in predicates))
    wanted = F.col("sortie_number").isNotNull()
    if sessions is not None:
        wanted = F.col("sortie_number").isin(*sessions)
    assert met.where(wanted & (F.col("met") != 1)).count() == 0
    assert met.where(~wanted & (F.col("met") > 0) | F.col("sortie_number").isNull() & (F.col("met") > 0)).count() == 0
    sizes = {p: tspi.where(p).count() for p in predicates}
    # Dense numbers are cut alike; those that are few, or are missing, can't be.
    assert all(n <= 560 for p, n in sizes.items() if "narrow" not in p and "unnumbered" not in p)
    big = [n for p, n in sizes.items() if "'big'" in p]
    assert len(big) == 7 and max(big) < 1.2 * min(big) + 40
    if sessions is None:
        assert 7 + 2 + 1 + 3160 // 500 <= len(predicates) <= 25


def test_cuts_at_the_edges():
    cut = lambda *e: jdbc.scan_predicates([jdbc.Extent("S", *e)], 10)
    assert cut(10, 1, 10) == ["sortie_number = 'S'"]
    assert cut(100, 5, 5) == cut(100) == ["sortie_number = 'S'"]
    assert cut(20, 1, 2) == [
        "sortie_number = 'S' AND (message_sequence_number < 2 OR message_sequence_number IS NULL)",
        "sortie_number = 'S' AND message_sequence_number >= 2",
    ]
    assert jdbc.scan_predicates([]) == []
    far = cut(30, -(2**63), 2**63 - 1)
    assert len(far) == 3 and f"< {-(2**63) + 2**64 // 3}" in far[0]


def test_the_scan_is_one_task_per_condition(spark, monkeypatch):
    """The reader is asked for what the database tells, and nothing is read of no sessions."""
    asked = []
    monkeypatch.setattr(jdbc, "extents", lambda *_: [jdbc.Extent("a", 25, 1, 25)])
    monkeypatch.setattr(type(spark.read), "jdbc", lambda self, *a, **k: asked.append(k["predicates"]) or spark.range(1))
    jdbc.read_table(spark, CONNECTION, "db.tspi", rows_per_task=10)
    monkeypatch.setattr(jdbc, "extents", lambda *_: [])
    jdbc.read_table(spark, CONNECTION, "db.tspi", [])
    assert len(asked[0]) == 3 and asked[1] == ["1 = 0"]


def test_staged_rows_of_the_newest_whole_run(spark):
    """Tasks run twice, a run that stopped, an older run: in SQL, on the staged rows."""
    import duckdb

    target = TargetSpec("t", ("sortie_number", "event_ts", "v"), ())
    rows = target_rows(spark, ("A", 1, "a"), ("A", 2, "b"), ("B", 1, "c")).repartition(2)
    frame = lambda run, df: jdbc.staged(df, run).toPandas()
    whole = frame("r2", rows)
    assert list(whole.columns) == ["sortie_number", "event_ts", "v", "run_id", "part_id"]
    older = frame("r1", target_rows(spark, ("A", 1, "old"), ("Z", 1, "old")))
    stopped = frame("r3", target_rows(spark, ("A", 1, "half")))
    database = duckdb.connect()
    import pandas as pd

    database.register("staging", pd.concat([older, whole, whole.iloc[:2], stopped]))
    database.execute("CREATE TABLE staging_runs (run_id VARCHAR, finished_at TIMESTAMP)")
    select = jdbc.staged_rows(target.columns, target.keys, "staging", "staging_runs")
    assert database.sql(select).fetchall() == []
    for run in ("r1", "r2"):
        database.execute(jdbc.finish_statement("staging_runs", run))
    for _ in range(2):
        got = sorted((r[0], r[1].hour, r[2]) for r in database.sql(select).fetchall())
        assert got == [("A", 1, "a"), ("A", 2, "b"), ("B", 1, "c")]
    merge = jdbc.merge_statement(target, "t", "staging", "staging_runs")
    assert merge == f"INSERT INTO t (sortie_number, event_ts, v) {select} ON DUPLICATE KEY UPDATE v = VALUES(v)"
    database.execute("CREATE TABLE kept AS SELECT * FROM staging")
    database.execute(jdbc.clear_statement("kept", "staging_runs"))
    assert database.sql("SELECT DISTINCT run_id FROM kept").fetchall() == [("r2",)]


def test_a_run_is_whole_only_after_its_rows(spark, monkeypatch):
    """Rows first, then the run's name, then the merge; a write that fails names no run."""
    done = []
    writer = type(spark.range(1).write)
    monkeypatch.setattr(writer, "save", lambda self: done.append("rows"))
    monkeypatch.setattr(jdbc, "_execute", lambda s, c, statements: done.extend(statements))
    run = jdbc.write_staged(target_rows(spark, ("A", 1, "a")), CONNECTION, "db.t_staging", "MERGE")
    assert done == [
        "rows", jdbc.finish_statement("db.t_staging_runs", run), "MERGE",
        jdbc.clear_statement("db.t_staging", "db.t_staging_runs"),
    ]

    def fail(self):
        raise OSError

    done.clear()
    monkeypatch.setattr(writer, "save", fail)
    with pytest.raises(OSError):
        jdbc.write_staged(target_rows(spark, ("A", 1, "a")), CONNECTION, "db.t_staging", "MERGE")
    assert done == []


def test_a_connection_file_holds_no_password(tmp_path, monkeypatch):
    from logbraid.__main__ import connection_from

    file = tmp_path / "c.json"
    file.write_text(
        '{"url": "jdbc:x", "driver": "d", "user": "u", "password_variable": "SECRET",'
        ' "split": {"lower": 0, "upper": 9, "parts": 3}}'
    )
    monkeypatch.setenv("SECRET", "p")
    assert connection_from(file) == (jdbc.Connection("jdbc:x", "d", "u", "p"), jdbc.Split(0, 9, 3))


def test_updates_keep_the_key(spark):
    """A key twice, and no key, written twice."""
    target = TargetSpec("t", ("sortie_number", "event_ts", "message_sequence_number", "v"), ())
    hour = lambda h: datetime(1970, 1, 1, h)
    path = fresh_folder(spark, "target")
    update = spark.createDataFrame(
        [("S", hour(1), 1, "old"), ("S", hour(1), 2, "new"), ("S", None, 3, "x"), (None, hour(1), 4, "y")],
        target.schema,
    )
    for _ in range(2):
        refused = upsert_table(spark, path, update, target)
        assert sorted(r.v for r in refused.collect()) == ["x", "y"]
        got = read_target(spark, path, target).collect()
        assert [(r.sortie_number, r.v) for r in got] == [("S", "new")]


@pytest.mark.parametrize("sessions", [None, ["S07"]], ids=["unnamed", "named"])
def test_upsert_reads_only_touched_sessions(spark, sessions):
    target = TargetSpec("t", ("sortie_number", "event_ts", "v"), ())
    path = fresh_folder(spark, "target")
    rows = [(f"S{i:02}", datetime(1970, 1, 1, 1), "a") for i in range(50)]
    upsert_table(spark, path, spark.createDataFrame(rows, target.schema), target)
    update = spark.createDataFrame([("S07", datetime(1970, 1, 1, 2), "b")], target.schema)
    existing = touched_partitions(read_target(spark, path, target), update, sessions)
    assert existing.count() == 1
    executed = existing._jdf.queryExecution().executedPlan()
    existing._jdf.queryExecution().toRdd().count()
    files = files_read(executed, "event_ts#")
    assert files == 1
    upsert_table(spark, path, update, target, sessions)
    assert read_target(spark, path, target).count() == 51


TARGET = TargetSpec("t", ("sortie_number", "event_ts", "v"), ())


def target_rows(spark, *rows):
    return spark.createDataFrame([(s, datetime(1970, 1, 1, h), v) for s, h, v in rows], TARGET.schema)


def held(spark, path, **read):
    return sorted((r[0], r[1].hour, r[2]) for r in Generations(spark, path, TARGET.schema).read(**read).collect())


def test_a_write_that_stops_before_its_end_changes_nothing(spark, monkeypatch):
    path = fresh_folder(spark, "target")
    first = [("A", 1, "old"), ("B", 1, "old"), ("C", 1, "old")]
    second = [("A", 1, "new"), ("B", 2, "new"), ("D", 1, "new")]
    upsert_table(spark, path, target_rows(spark, *first), TARGET)
    reading = read_target(spark, path, TARGET)

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched, pytest.raises(KeyboardInterrupt):
        patched.setattr(Generations, "_put_in_force", stop)
        upsert_table(spark, path, target_rows(spark, *second), TARGET)
    # All of the new rows are on disk, none is read.
    assert held(spark, path) == sorted(first)
    upsert_table(spark, path, target_rows(spark, *second), TARGET)
    want = sorted([("A", 1, "new"), ("B", 1, "old"), ("B", 2, "new"), ("C", 1, "old"), ("D", 1, "new")])
    assert held(spark, path) == want
    # Who read before goes on with what it began with, and the old version can still be had.
    assert sorted(r.v for r in reading.collect()) == ["old"] * 3
    assert held(spark, path, version=1) == sorted(first)
    Generations(spark, path, TARGET.schema).drop_old()
    assert held(spark, path) == want
    assert len(os.listdir(f"{path.removeprefix('file:')}/data")) == 2
    assert not any(n.startswith("staged") for n in os.listdir(path.removeprefix("file:")))


def test_the_first_of_two_writes_takes_effect(spark):
    path = fresh_folder(spark, "target")
    table = Generations(spark, path, TARGET.schema)
    key = lambda rows: rows.select("sortie_number")
    table.replace(rows := target_rows(spark, ("A", 1, "first")), ["event_ts"], key(rows), version=0)
    with pytest.raises(OtherWrite):
        table.replace(rows := target_rows(spark, ("A", 1, "late")), ["event_ts"], key(rows), version=0)
    assert held(spark, path) == [("A", 1, "first")]
    assert table.version() == 1


def test_replaced_sessions_are_left_out_and_dropped(spark):
    path = fresh_folder(spark, "target")
    for n in range(4):
        rows = target_rows(spark, (f"S{n}", 1, "own"), ("all", n, str(n)), ("o'b/x=1 %", 1, str(n)))
        upsert_table(spark, path, rows, TARGET)
    want = sorted([(f"S{n}", 1, "own") for n in range(4)] + [("all", n, str(n)) for n in range(4)] + [("o'b/x=1 %", 1, "3")])
    assert held(spark, path) == want
    assert held(spark, path, sessions=["all"]) == [w for w in want if w[0] == "all"]
    for _ in range(2):
        Generations(spark, path, TARGET.schema).drop_old()
        assert held(spark, path) == want


def test_replaced_rows_of_a_session_are_gone(spark):
    path = fresh_folder(spark, "rejects")
    schema = "sortie_number string, message_sequence_number long, why string"
    frame = lambda *rows: spark.createDataFrame(rows, schema)
    left = lambda: {tuple(r) for r in read_kept(spark, path, frame().schema).collect()}
    replace_sessions(spark, path, frame(("A", 1, "x"), ("B", 1, "x"), (None, 1, "x")))
    replace_sessions(spark, path, frame(("C", 2, "y")), ["A", "C"])
    assert left() == {("B", 1, "x"), ("C", 2, "y"), (None, 1, "x")}
    replace_sessions(spark, path, frame((None, 2, "y"), ("B", 3, "z")))
    assert left() == {("B", 3, "z"), (None, 2, "y")}


def files_read(plan, column):
    """The files that the scan of a table with this column opened, by its own metric."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return files_read(plan.executedPlan(), column)
    if name.endswith("QueryStageExec"):
        return files_read(plan.plan(), column)
    if name == "FileSourceScanExec" and column in plan.toString():
        return plan.metrics().get("numFiles").get().value()
    children = plan.children()
    for i in range(children.size()):
        found = files_read(children.apply(i), column)
        if found is not None:
            return found
    return None


def test_a_run_leaves_no_folder(spark):
    path = None
    with scratch(spark) as folder:
        path = folder
        assert materialize(spark.range(5), "five").count() == 5
        with pytest.raises(ZeroDivisionError), scratch(spark):
            materialize(spark.range(2), "two")
            raise ZeroDivisionError
        assert os.listdir(path.removeprefix("file:"))
    assert not os.path.exists(path.removeprefix("file:"))


def test_cluster_sessions_get_no_local_folder(spark, monkeypatch):
    class Context:
        master = "local-cluster[2,1,1024]"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context

        class conf:
            get = staticmethod(lambda *a: None)

    with pytest.raises(RuntimeError, match="checkpoint"):
        checkpoint_dir(Session)


def test_database_times_become_text(spark):
    df = spark.sql("SELECT timestamp'1970-01-01 23:59:58.25' AS local_time, 'x' AS weapon_id")
    assert jdbc.clocks_as_text(df).first() == ("23:59:58.250", "x")


def test_declared_types_win():
    spec = SourceSpec("s", ("sortie_number", "v"), types={"v": MISSILE.schema["event_ts"].dataType})
    assert spec.schema["v"].dataType.simpleString() == "timestamp_ntz"


def test_landing_reads_its_input_once_and_keeps_blocks_apart(spark, log_frame):
    import glob

    import pyarrow.parquet as pq

    spec, path = SOURCES["ir_msl"], fresh_folder(spark, "landed")
    rows = [{"sortie_number": "big" if n % 9 else f"s{n % 4}", "message_sequence_number": n} for n in range(3000)]
    rows.append({"sortie_number": "big"})
    source = fresh_folder(spark, "source")
    log_frame(spec, rows).repartition(7).write.parquet(source)
    read = spark.read.schema(spec.schema).parquet(source)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    land_log(read.mapInArrow(counted, spec.schema), path, numbers=500)
    assert seen.value == len(rows)
    ranges = []
    for file in glob.glob(f"{path.removeprefix('file:')}/sortie_number=big/*/*.parquet"):
        data = pq.ParquetFile(file)
        column = data.schema_arrow.names.index("message_sequence_number")
        for i in range(data.num_row_groups):
            numbers = data.metadata.row_group(i).column(column).statistics
            if numbers.has_min_max:
                ranges.append((numbers.min, numbers.max))
    ranges.sort()
    assert len(ranges) == 6 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert read_table(spark, path, spec.schema).count() == len(rows)
    assert read_table(spark, path, spec.schema).columns == list(spec.columns)


@pytest.mark.parametrize("cuts", [(40,), (1, 2, 60), (100, 100)])
def test_runs_one_after_the_other_equal_one_over_all(spark, log_frame, cuts):
    """Clocks that jitter, are missing at the cuts, and sessions that begin and end anywhere."""
    import random

    from logbraid.operators.normalize import processed
    from logbraid.plans.onwards import unwrap_onwards

    spec, pick = SOURCES["ir_msl"], random.Random(sum(cuts))
    rows = [
        {
            "sortie_number": s, "message_sequence_number": n if n > 2 else None if s == "B" else n,
            "satellite_guidance_time": pick.choice([None, "bad", f"{(n * 5 + pick.randint(0, 3)) % 24:02}:00:00.000"]),
            "weapon_type": f"{s}{n}",
        }
        for s, first, last in (("A", 0, 90), ("B", 0, 50), ("C", 45, 95))
        for n in range(first, last)
    ]
    log, state = (fresh_folder(spark, n) for n in ("log", "state"))
    got, bounds = [], [-1, *cuts, 1000]
    for low, high in zip(bounds, bounds[1:]):
        part = [r for r in rows if low < (r["message_sequence_number"] or 0) <= high]
        if part:
            land_log(log_frame(spec, part), log, numbers=10)
        run = unwrap_onwards(spark, spec, log, state, numbers=10)
        got += run.rows.collect()
        # A run that stops before its commit is done again alike.
        again = unwrap_onwards(spark, spec, log, state, numbers=10)
        assert sorted(map(str, again.rows.collect())) == sorted(map(str, run.rows.collect()))
        run.commit()
    whole = processed(log_frame(spec, rows), spec)
    assert sorted(map(str, got)) == sorted(map(str, whole.select(*run.rows.columns).collect()))
    assert unwrap_onwards(spark, spec, log, state, numbers=10).rows.count() == 0
    with pytest.raises(OtherWrite):
        again.commit()


def test_a_second_run_reads_only_new_blocks(spark, log_frame):
    from logbraid.plans.onwards import unwrap_onwards

    spec = SOURCES["ir_msl"]
    log, state = (fresh_folder(spark, n) for n in ("log", "state"))

    def land(first, last):
        rows = [
            {"sortie_number": s, "message_sequence_number": n, "satellite_guidance_time": f"{n % 24:02}:00:00.000"}
            for s in "AB" for n in range(first, last)
        ]
        land_log(log_frame(spec, rows), log, numbers=10)

    land(0, 200)
    unwrap_onwards(spark, spec, log, state, numbers=10).commit()
    land(200, 220)
    rows = unwrap_onwards(spark, spec, log, state, numbers=10).rows
    executed = rows._jdf.queryExecution().executedPlan()
    assert rows._jdf.queryExecution().toRdd().count() == 40
    # Per session the two new blocks, and the one that the last tick is in.
    assert files_read(executed, "weapon_type#") == 6
