from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from logbraid.operators.normalize import normalize, processed
from logbraid.operators.profile import choose_main, source_counts
from logbraid.operators.target import collapse, project_to_target
from logbraid.sources.registry import MISSILE, SOURCE_TABLE, SOURCES


def test_counts_and_spine(spark, log_frame):
    def tables(**sizes):
        return {
            name: log_frame(SOURCES[name], [{"sortie_number": "S1"}] * n + [{"sortie_number": None}])
            for name, n in sizes.items()
        }

    counts = source_counts(tables(aa_traj=10, ir_msl=3, sa_traj=0))
    assert {(r.source, r.n) for r in counts.collect()} == {("aa_traj", 10), ("ir_msl", 3)}
    assert source_counts(tables(aa_traj=1), ["S9"]).count() == 0
    declared = [s.name for s in MISSILE.sources]
    assert choose_main(counts, declared).collect() == [("S1", "ir_msl")]
    tie = source_counts(tables(aa_traj=3, ir_msl=3))
    assert choose_main(tie, declared).collect() == [("S1", "aa_traj")]


def test_rename(log_frame):
    spec = SOURCES["ag_rtsn"]
    row = {"sortie_number": "S1", "weapon_pylon_id": "P1", "aircraft_heading": "90"}
    got = normalize(log_frame(spec, [row]), spec).first()
    assert (got.pylon_id, got.heading) == ("P1", "90")


def test_fill_to_target(log_frame):
    spec = SOURCES["ir_msl"]
    row = {c: "v" for c in spec.columns} | {
        "message_sequence_number": 4, "satellite_guidance_time": "10:00:00.000"
    }
    filled = project_to_target(processed(log_frame(spec, [row]), spec), MISSILE.schema)
    assert filled.schema.simpleString() == MISSILE.schema.simpleString()
    got = filled.first()
    assert got[SOURCE_TABLE] == "ir_msl" and got.event_ts == datetime(1970, 1, 1, 10)
    assert sum(v is None for v in got) == 65


def test_collapse(spark):
    df = spark.createDataFrame(
        [("S1", 1, 7, "a"), ("S1", 1, 9, "b"), ("S1", 1, 9, None), ("S1", 2, None, "c"), ("S1", 2, 0, "z")],
        "k string, ts int, message_sequence_number long, v string",
    )
    got = {tuple(r) for r in collapse(df, ["k", "ts"]).collect()}
    assert got == {("S1", 1, 9, "b"), ("S1", 2, 0, "z")}


def test_collapse_reduces_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), F.col("id").alias("message_sequence_number"))
    plan = collapse(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
